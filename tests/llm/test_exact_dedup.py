import hashlib

from reviewloom.llm.exact_dedup import exact_dedup
from tests.llm.helpers import corpus, table


def expected(rows):
    bare = {i: "".join(c for c in t or "" if c not in " \t\n\x0b\x0c\r") for i, t in enumerate(t for _, t in rows)}
    groups = {}
    for i, (doc, text) in enumerate(rows):
        groups.setdefault(bare[i], []).append((-len(text or ""), doc is None, doc or 0, doc))
    out = []
    for i, (doc, _) in enumerate(rows):
        group = groups[bare[i]]
        keep = min(group)[3]
        out.append((doc, keep, len(group), doc == keep, hashlib.sha256(bare[i].encode()).hexdigest()))
    return sorted(out, key=repr)


def test_matches_its_definition(spark):
    rows = corpus() + [(None, "a b"), (500, "ab "), (501, "a\tb"), (None, "only null")]
    rows += [(600 + i, "hot text " * (i % 3)) for i in range(40)]
    for salts in (1, 16):
        got = exact_dedup(table(spark, rows, extra=True), salts=salts)
        assert sorted(map(tuple, got.collect()), key=repr) == expected(rows)


def test_empty_table(spark):
    assert exact_dedup(table(spark, [])).columns[:2] == ["doc_id", "keep_id"]
    assert exact_dedup(table(spark, [])).count() == 0


def test_other_ids(spark):
    df = spark.createDataFrame([("b", "x"), ("a", "x"), ("c", None)], "name string, body string")
    got = exact_dedup(df, "name", "body")
    assert {(r.name, r.keep_id) for r in got.collect()} == {("a", "a"), ("b", "a"), ("c", "c")}
