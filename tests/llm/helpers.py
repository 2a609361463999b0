"""Small tables with the awkward cases: nulls, empty, blank and long texts, repeats, clashing columns."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that the operators use inside, or return.
CLASHING = (
    "id", "text_key", "w", "pos", "word", "key", "n", "kept", "keep_id", "size", "target", "part",
    "digest", "salt", "h1", "component_id", "taken", "no", "language", "__id",
)


def table(spark: SparkSession, rows: list[tuple], extra: bool = False) -> DataFrame:
    """doc_id and text, or all columns of documents."""
    full = [(*r, *("en", "s1", None)[len(r) - 2 :]) if len(r) < 5 else r for r in rows]
    df = spark.createDataFrame(full, SCHEMA)
    if extra:
        for name in CLASHING:
            df = df.withColumn(name, F.lit("x"))
    return df


def words(rng: random.Random, n: int, size: int = 40) -> list[str]:
    return [f"w{rng.randrange(size)}" for _ in range(n)]


def corpus(seed: int = 3, n: int = 120) -> list[tuple[int, str | None]]:
    """Random texts, near copies of some of them, exact copies, and the awkward ones."""
    rng = random.Random(seed)
    rows: list[tuple[int, str | None]] = []
    bases = []
    for i in range(n):
        kind = rng.random()
        if bases and kind < 0.35:
            base = list(rng.choice(bases))
            for _ in range(rng.randrange(0, 4)):
                base[rng.randrange(len(base))] = f"n{rng.randrange(1000)}"
            text = " ".join(base)
        else:
            base = words(rng, rng.choice([1, 2, 3, 5, 9, 20, 60, 150]), 400)
            bases.append(base)
            text = " ".join(base)
        if rng.random() < 0.2:
            text = text.upper().replace(" ", "\n")
        rows.append((i, text))
    rows += [(n, None), (n + 1, ""), (n + 2, " \t\n\x0b\x0c\r"), (n + 3, rows[0][1]), (n + 3, rows[0][1])]
    rows += [(n + 4, "É é İ K ſ"), (n + 5, " ".join(words(rng, 30_000, 5000)))]
    return rows
