import random

import pytest

from reviewloom.llm import line_dedup
from tests.llm.helpers import table

SPACES = " \t\n\x0b\x0c\r"


def key(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(SPACES))


def order(doc):
    return (doc is None, doc or 0)


def expected(rows, least=10):
    first = {}
    for doc, text in rows:
        for line in (text or "").split("\n"):
            k = key(line)
            first[k] = min(first.get(k, order(doc)), order(doc))
    return [
        (doc, "\n".join(x for x in (t or "").split("\n") if len(key(x)) < least or first[key(x)] == order(doc)))
        for doc, t in rows
    ]


def cases():
    rng = random.Random(2)
    lines = [f"line number {i} é" for i in range(30)] + ["short", "", "  ", "ÉÉÉÉÉÉÉÉÉÉ", "éééééééééé"]
    rows = []
    for i in range(150):
        own = [rng.choice(lines) for _ in range(rng.randrange(0, 12))]
        own = [x.upper() if rng.random() < 0.1 else f" {x}\r" if rng.random() < 0.2 else x for x in own]
        rows.append((i, "\n".join([*own, "the very common line"])))
    rows += [(200, None), (201, ""), (202, "\n\n"), (None, "line number 3 é\nonly with null id"), (203, "only with null id")]
    rows += [(204, "twice in one document\ntwice in one document"), (7, "line number 5 é\nanother text of seven")]
    rows += [(205, "\n".join(f"long document line {i}" for i in range(20_000)))]
    return rows


@pytest.mark.parametrize("parts", [1, 40])
def test_matches_its_definition(spark, monkeypatch, parts):
    """Many ranges: the common line spans several of them."""
    monkeypatch.setattr(line_dedup, "BATCH_LINES", 50)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = cases()
        docs = table(spark, rows, extra=True)
        got = line_dedup.drop_repeated_lines(docs)
        assert got.columns == docs.columns
        found = sorted((order(r.doc_id), r.text or "") for r in got.collect())
        assert found == sorted((order(d), t) for d, t in expected(rows))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_streamed_batches_agree(spark):
    """Runs of one key over several record batches of one range."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        rows = cases()
        got = line_dedup.drop_repeated_lines(table(spark, rows))
        found = sorted((order(r.doc_id), r.text or "") for r in got.collect())
        assert found == sorted((order(d), t) for d, t in expected(rows))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_lengths_and_empty_table(spark):
    rows = [(1, "a line of some length"), (2, "a line of some length\nrest"), (3, None)]
    got = {r.doc_id: (r.text, r.n_chars) for r in line_dedup.drop_repeated_lines(table(spark, rows)).collect()}
    assert got == {1: ("a line of some length", None), 2: ("rest", 4), 3: (None, None)}
    assert line_dedup.drop_repeated_lines(table(spark, [])).count() == 0
