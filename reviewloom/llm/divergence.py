"""How far the word use of sources differs: exact divergences by three-dimensional cube partitioning."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema
from pyspark.sql.window import Window

from reviewloom.llm.common import column, text_batches, text_of
from reviewloom.session import land

#: Every ASCII byte but letters becomes a blank, A-Z are lowered; bytes of other letters stay.
_TABLE = bytes(
    i | 0x20 if 0x41 <= i <= 0x5A else i if 0x61 <= i <= 0x7A or i >= 0x80 else 0x20 for i in range(256)
)
#: Distinct (group, term) that a task counts before it hands its counts on.
HELD = 400_000
#: Groups and terms on the sides of a cell.
GROUP_BLOCK, TERM_BLOCK = 16, 4096

COUNTS = pa.schema(
    [("lang", pa.string()), ("source", pa.string()), ("term", pa.binary()), ("n", pa.int64()), ("docs", pa.int64())]
)


def terms_of(text: str) -> list[bytes]:
    return text.encode().translate(_TABLE).split()


def _counter(held_terms: int):
    """Counts per group and term of a task's texts; a row without a term says that a group exists."""

    def rows(counts: dict[tuple[str, str], dict[bytes, list[int]]]) -> Iterator[pa.RecordBatch]:
        for (lang, source), held in counts.items():
            n, docs = zip(*held.values()) if held else ((), ())
            k = len(held) + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * k), pa.array([source] * k), pa.array([None, *held], pa.binary()),
                 pa.array([0, *n], pa.int64()), pa.array([0, *docs], pa.int64())],
                schema=COUNTS,
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple[str, str], dict[bytes, list[int]]] = {}
        size = 0
        for batch in batches:
            langs, sources = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for group, text in zip(zip(langs, sources), batch.column(2)):
                held = counts.setdefault(group, {})
                size -= len(held)
                for term, n in Counter(terms_of(text.as_py())).items():
                    if term in held:
                        both = held[term]
                        both[0] += n
                        both[1] += 1
                    else:
                        held[term] = [n, 1]
                size += len(held)
                if size > held_terms:
                    yield from rows(counts)
                    counts, size = {}, 0
        yield from rows(counts)

    return run


def _share(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(10^9 * (count + 5) / (total + 5 * kept)), exact, as decimals hold the product; without kept terms
    there is nothing to share."""
    part = (count + 5).cast("decimal(20,0)") * F.lit(1_000_000_000).cast("decimal(10,0)")
    whole = F.greatest(total + 5 * kept, F.lit(1)).cast("decimal(20,0)")
    return F.call_function("div", part, whole) + 1


_SLICES = pa.schema(
    [("lang", pa.string()), ("groups", pa.int32()), ("terms", pa.int32()), ("low", pa.int64()),
     ("matrix", pa.binary()), ("height", pa.int32())]
)
PARTIAL = pa.schema([("lang", pa.string()), ("a", pa.int64()), ("b", pa.int64()), ("value", pa.int64())])


def _slice(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One slice: the shares of a block of groups for a block of terms, absent ones filled in."""
    lang, groups, terms = (k.as_py() for k in key)
    heads, cells = [], []
    for batch in batches:
        number, place, p, width = (
            batch.column(name).to_numpy(zero_copy_only=False) for name in ("number", "place", "p", "width")
        )
        head = place < 0
        heads.append((number[head], p[head], width[head]))
        cells.append((number[~head], place[~head], p[~head]))
    number, p, width = (np.concatenate(x) for x in zip(*heads))
    low = int(number.min())
    shares = np.zeros((int(number.max()) - low + 1, int(width.max())), dtype="<i4")
    shares[number - low] = p.astype("<i4")[:, None]
    for number, place, p in cells:
        shares[number - low, place] = p
    yield pa.RecordBatch.from_pydict(
        {"lang": [lang], "groups": [groups], "terms": [terms], "low": [low], "matrix": [shares.tobytes()],
         "height": [len(shares)]},
        schema=_SLICES,
    )


def _cell(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial divergences of all pairs of a cell: of one block of groups, or between two."""
    slices = []
    for batch in batches:
        for row in batch.to_pylist():
            shares = np.frombuffer(row["matrix"], dtype="<i4").astype(np.int64)
            slices.append((row["low"], shares.reshape(row["height"], len(shares) // row["height"])))
    slices.sort(key=lambda s: s[0])
    (low_a, first), (low_b, second) = slices[0], slices[-1]
    a, b, value = [], [], []
    for i, shares in enumerate(first):
        start = i + 1 if len(slices) == 1 else 0
        apart = np.abs(second[start:] - shares).sum(axis=1)
        a.append(np.full(len(apart), low_a + i))
        b.append(low_b + np.arange(start, len(second)))
        value.append(apart)
    a, b, value = (np.concatenate(x).astype(np.int64) for x in (a, b, value))
    lang = pa.array([key[0].as_py()] * len(a), pa.string())
    yield pa.RecordBatch.from_arrays([lang, *map(pa.array, (a, b, value))], schema=PARTIAL)


def divergences(
    docs: DataFrame,
    least_docs: int = 30,
    top_terms: int = 50,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
) -> DataFrame:
    """Divergence of each source of a language from the others, and the terms that mark it.

    Terms are maximal runs of ASCII letters and characters beyond ASCII, A-Z lowered; a language keeps
    those that ``least_docs`` of its documents hold. A group's share of a kept term is
    1 + floor(10^9 (count + 5) / (N + 5 V)), with N its counts of all V kept terms; all is exact.

    Returns ``lang``, ``source``, ``part``, ``item``, ``value``, ``rank``. Part ``pair``: ``item`` is
    another source of the language and ``value`` the sum of the differences of shares over all kept
    terms (0 without any). Part ``term``: ``item`` is a kept term that the group has and whose share
    is above the language's, ``value`` the difference; the first ``top_terms`` ranks. Ranks go by
    falling value, then by ``item`` in UTF-8.

    Null texts, languages and sources are empty ones; every occurring group counts, even without terms;
    repeated rows are documents of their own; an empty table gives no rows; other columns, ids too, are
    not read.

    1. Tasks count their texts' terms by group, in a bounded table; the counts are summed and landed.
    2. A language's groups and kept terms are numbered in blocks; a slice holds the shares of a block of
       groups for a block of terms. Slices are replicated to the cells (group block, group block, term
       block) that need them, cells add up differences, and sums over the term axis end the pairs.
    """
    texts = docs.select(
        text_of(docs, lang_col).alias("lang"),
        text_of(docs, source_col).alias("source"),
        text_of(docs, text_col).alias("text"),
    )
    part = texts.mapInArrow(_counter(HELD), from_arrow_schema(COUNTS))
    with text_batches(docs.sparkSession):
        counts = land(
            part.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "counts"
        )
    terms = counts.where("term is not null")
    kept = terms.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"))
    kept = land(kept.where(F.col("docs") >= least_docs).drop("docs"), "kept-terms")
    langs = land(
        counts.where("term is null").select("lang").distinct().join(
            kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("lang_n").alias("lang_total")), "lang", "left"
        ).select(
            "lang", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("v", "lang_total")],
            F.greatest(F.ceil(F.col("v") / TERM_BLOCK), F.lit(1)).cast("int").alias("blocks"),
        ),
        "langs",
    )
    block = F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int")
    in_block = Window.partitionBy("lang", "terms").orderBy("term")
    kept = land(
        kept.join(langs, "lang").withColumn("terms", block)
        .withColumn("place", F.row_number().over(in_block) - 1)
        .withColumn("q", _share(F.col("lang_n"), F.col("lang_total"), F.col("v")))
        .select("lang", "term", "terms", "place", "q"),
        "numbered-terms",
    )
    used = land(terms.select("lang", "source", "term", "n").join(kept, ["lang", "term"]), "used-terms")
    totals = used.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    in_lang = Window.partitionBy("lang").orderBy("source")
    groups = land(
        counts.where("term is null").select("lang", "source")
        .join(totals, ["lang", "source"], "left").join(langs, "lang")
        .select(
            "lang", "source", F.coalesce("total", F.lit(0).cast("long")).alias("total"), "v", "blocks",
            (F.row_number().over(in_lang) - 1).cast("long").alias("number"),
        ),
        "groups",
    )
    shares = used.join(groups, ["lang", "source"]).withColumn("p", _share(F.col("n"), F.col("total"), F.col("v")))
    pairs = _pairs(shares, groups, kept)
    named = groups.select(F.col("lang").alias("g_lang"), "number", "source")
    for end, name in (("a", "source"), ("b", "item")):
        own = named.select("g_lang", "number", F.col("source").alias(name))
        pairs = pairs.join(own, (F.col("lang") == F.col("g_lang")) & (F.col(end) == F.col("number"))).drop("g_lang", "number")
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    marks = (
        shares.where("n > 0 and p > q")
        .select("lang", "source", F.decode("term", "UTF-8").alias("item"), (F.col("p") - F.col("q")).alias("value"))
        .withColumn("rank", F.row_number().over(by_value))
        .where(F.col("rank") <= top_terms)
    )
    pairs = pairs.select("lang", "source", "item", "value").withColumn("rank", F.row_number().over(by_value))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return (
        pairs.withColumn("part", F.lit("pair")).select(columns)
        .unionByName(marks.withColumn("part", F.lit("term")).select(columns))
    )


def _pairs(shares: DataFrame, groups: DataFrame, kept: DataFrame) -> DataFrame:
    """``lang``, ``a``, ``b`` (numbers of groups, both ways), ``value``."""
    side = (F.col("number") / GROUP_BLOCK).cast("int").alias("groups")
    width = kept.groupBy("lang", "terms").agg(F.count("*").cast("int").alias("width"))
    heads = groups.select(
        "lang", side, F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("terms"), "number",
        _share(F.lit(0).cast("long"), F.col("total"), F.col("v")).alias("p"),
    ).join(width, ["lang", "terms"], "left")
    columns = ["lang", "groups", "terms", "number", "place", "p", "width"]
    rows = (
        heads.withColumn("place", F.lit(-1)).withColumn("width", F.coalesce("width", F.lit(0))).select(columns)
        .unionByName(shares.select("lang", side, "terms", "number", "place", "p", F.lit(0).alias("width")).select(columns))
    )
    slices = rows.groupBy("lang", "groups", "terms").applyInArrow(_slice, from_arrow_schema(_SLICES))
    n_blocks = groups.groupBy("lang").agg((F.max("number") / GROUP_BLOCK).cast("int").alias("last"))
    placed = land(slices, "slices").join(n_blocks, "lang").withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("last")))
    )
    cells = placed.select(
        "*", F.least("groups", "other").alias("i"), F.greatest("groups", "other").alias("j")
    )
    partial = cells.groupBy("lang", "i", "j", "terms").applyInArrow(_cell, from_arrow_schema(PARTIAL))
    total = partial.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    both = F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"))))
    return total.select("lang", both.alias("ends"), "value").select("lang", "ends.a", "ends.b", "value")
