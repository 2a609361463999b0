"""Scan, numbering, validation, deduplication, and the joins they use."""

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from reviewloom import schemas as S
from reviewloom.operators import tokens
from reviewloom.operators.dedup import latest_per_review
from reviewloom.operators.ingest import make_run_id, with_ingest_metadata
from reviewloom.operators.lookups import first_per_key, hot_key_left_join, last_per_key, lookup
from reviewloom.operators.validate import (
    LengthLimits, assert_reasons, reason_violations, repeated_identities, split_by_validity, validate_reviews,
    with_first_occurrence,
)
from reviewloom.sources.reviews_csv import read_lexicons, scan_lexicon_csv, scan_reviews_csv

GOOD = "The room smelled of smoke"
CSV = f"""source,source_id,review_text,posted_at,user_name
a.com,1,{GOOD},2026/02/01 8:12,u1
a.com,2,"said ""no"",
twice over",2026/02/01 9:45,u2

b.com,,{GOOD},2026/02/14 8:26,u3
b.com,3,{GOOD},abc,u4
b.com,4,,2026/02/14 11:33,u5
b.com,5,abc,2026/02/14 13:57,u6
a.com,1,                    abc,2026/02/14 15:19,u7
,6,{GOOD},2026/02/14 19:58,u8
b.com,7,,,u9
b.com,8,{GOOD},15/2,u10
b.com,8,{GOOD},2026/02/15 11:00,u11
b.com,9
"""
EXPECTED = [
    [], [], [S.MISSING_ID], [S.POSTED_PARSE_FAILED], [S.TEXT_EMPTY], [S.TEXT_TOO_SHORT],
    [S.DUPLICATE, S.TEXT_TOO_SHORT], [S.MISSING_ID], [S.POSTED_MISSING, S.TEXT_EMPTY], [S.POSTED_PARSE_FAILED],
    [S.DUPLICATE], [S.POSTED_MISSING, S.TEXT_NOT_STRING],
]


@pytest.fixture
def stamped(spark, tmp_path):
    (tmp_path / "hotel.csv").write_text(CSV, encoding="utf-8")
    return with_ingest_metadata(
        scan_reviews_csv(spark, str(tmp_path / "hotel.csv")), "run_1", datetime(2026, 3, 1, 10, 0, 0, 5), repeatable=True)


def test_scan_and_stamp(stamped):
    rows = stamped.orderBy("row_number").collect()
    assert [r.row_number for r in rows] == list(range(1, 13))
    assert rows[1].review_text == 'said "no",\ntwice over'
    assert rows[3].source_id == "3" and rows[2].source_id == ""
    assert rows[11].review_text is None and rows[11].user_name is None
    assert {(r.source_file, r.run_id, str(r.ingested_at)) for r in rows} == {("hotel.csv", "run_1", "2026-03-01 10:00:00")}
    assert len({r.row_id for r in rows}) == 12


def test_rows_are_numbered_per_file_across_splits(spark, tmp_path):
    """Small splits and single-line rows, so that files are cut into several blocks."""
    for name, n in (("x", 700), ("y", 5), ("z", 1200)):
        (tmp_path / f"{name}.csv").write_text("k\n" + "".join(f"{name}{i}\n" for i in range(1, n + 1)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    spark.conf.set("spark.sql.files.openCostInBytes", "10")
    try:
        scan = spark.read.csv(str(tmp_path), header=True, schema="k string")
        assert scan.rdd.getNumPartitions() > 5
        numbered = with_ingest_metadata(scan, "run").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert len(numbered) == 1905
    assert all(r.k == f"{r.source_file[0]}{r.row_number}" for r in numbered)


def test_run_id_format():
    import re

    assert re.fullmatch(r"reviews_\d{8}T\d{6}Z_[0-9a-f]{8}", make_run_id())


def test_validation_messages(stamped):
    rows = validate_reviews(stamped).orderBy("row_number").collect()
    assert [r.invalid_reason for r in rows] == EXPECTED
    assert [r.is_valid for r in rows] == [not e for e in EXPECTED]
    assert [r.review_id is None for r in rows] == [S.MISSING_ID in e for e in EXPECTED]


def test_length_limits(spark, stamped):
    texts = ["x" * 500, "x" * 501, "　" + "x" * 5 + "　", "x" * 4, "😂" * 5]
    rows = stamped.limit(1).select("*", F.posexplode(F.array(*[F.lit(t) for t in texts])).alias("i", "t"))
    rows = rows.withColumns({"review_text": F.col("t"), "source_id": F.col("i").cast("string"), "row_number": F.col("i")})
    got = [r.invalid_reason for r in validate_reviews(rows).orderBy("row_number").collect()]
    assert got == [[], [S.TEXT_TOO_LONG], [], [S.TEXT_TOO_SHORT], []]
    wide = [r.invalid_reason for r in validate_reviews(rows, LengthLimits(1, 1000)).collect()]
    assert wide == [[]] * 5


def test_split(stamped):
    good, bad = split_by_validity(validate_reviews(stamped))
    assert (good.count(), bad.count()) == (2, 10)
    assert {len(r.tokens) for r in bad.collect()} == {0}


@pytest.mark.parametrize("max_broadcast", [100_000, 0])
def test_first_occurrence_under_a_hot_identity(spark, max_broadcast):
    rng = random.Random(1)
    rows = [("run", "s", "hot" if rng.random() < 0.4 else str(rng.randint(0, 300)), f"f{rng.randint(0, 1)}", n) for n in range(2000)]
    rows += [("run", "", "x", "f0", n) for n in range(2000, 2500)] + [("run", None, None, "f0", n) for n in range(2500, 2600)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "run_id string, source string, source_id string, source_path string, row_number long")
    first, copies = {}, {}
    for r in rows:
        key = r[:3]
        first[key], copies[key] = min(first.get(key, r[3:]), r[3:]), copies.get(key, 0) + 1
    got = with_first_occurrence(df, max_broadcast).collect()
    assert len(got) == len(rows)
    for r in got:
        key = (r.run_id, r.source, r.source_id)
        assert r.first_row == (first[key] if r.source and r.source_id and copies[key] > 1 else None)


def test_hot_key_join_equals_plain_join(spark, monkeypatch):
    from reviewloom.operators import lookups

    monkeypatch.setattr(lookups, "HOT_KEYS", 2)
    facts = spark.createDataFrame([(i, "a" if i % 3 else f"k{i % 50}") for i in range(600)] + [(999, None)], "i long, k string")
    dim = spark.createDataFrame([("a", 1, "x")] + [(f"k{j}", j, None) for j in range(0, 40, 3)], "k string, v int, w string")
    weight = facts.groupBy("k").agg(F.count("*").alias("copies"))
    got = hot_key_left_join(facts, dim, ["k"], weight, F.col("i")).select("i", "k", "v", "w")
    want = facts.join(dim, "k", "left").select("i", "k", "v", "w")
    assert sorted(got.collect(), key=str) == sorted(want.collect(), key=str)
    oversized = lookup(facts, dim, ["k"], F.col("i"), max_bytes=1).select("i", "k", "v", "w")
    assert sorted(oversized.collect(), key=str) == sorted(want.collect(), key=str)


def test_unknown_hot_words_are_spread(spark, monkeypatch):
    """Half of the rows carry one word that the dictionary lacks; no partition may hold them."""
    facts = spark.range(40_000).selectExpr("id", "if(id % 2 = 0, 'unknown', concat('k', id % 5000)) AS k")
    dim = spark.range(5000).selectExpr("concat('k', id) AS k", "id AS v")
    options = {
        "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "64",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    before = {k: spark.conf.get(k, None) for k in options}
    for k, v in options.items():
        spark.conf.set(k, v)
    try:
        joined = lookup(facts, dim, ["k"], F.col("id"), max_bytes=0)
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        assert joined.where("v IS NOT NULL").count() == 20_000
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert sum(sizes) == 40_000 and max(sizes) < 0.05 * 40_000


def test_files_of_one_name_are_told_apart(spark, tmp_path):
    for folder in ("a", "b"):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "r.csv").write_text(f"source,source_id,review_text,posted_at,user_name\na.com,1,{GOOD},2026/02/01,u\n")
    scan = scan_reviews_csv(spark, [str(tmp_path / "a"), str(tmp_path / "b")])
    rows = validate_reviews(with_ingest_metadata(scan, "run", repeatable=True)).orderBy("source_path").collect()
    assert len({r.row_id for r in rows}) == 2 and {r.source_file for r in rows} == {"r.csv"}
    assert [r.invalid_reason for r in rows] == [[], [S.DUPLICATE]]


def test_first_and_last_per_key(spark):
    rows = spark.createDataFrame([("t", "A", 2), ("t", "B", 1), ("u", "C", 3)], "term string, v string, n int")
    assert sorted(map(tuple, first_per_key(rows, ["term"], "v", ["n"]).collect())) == [("t", "B"), ("u", "C")]
    assert sorted(map(tuple, last_per_key(rows, ["term"], "v", ["n"]).collect())) == [("t", "A"), ("u", "C")]


def test_lexicons_keep_the_first_row_per_term(spark, tmp_path):
    (tmp_path / "s.csv").write_text("term,polarity,language\nbad,negative,en\nbad,positive,en\ngood,positive,en\nodd,neutral,en\n")
    (tmp_path / "e.csv").write_text("term,language,entity,version\npillow,en,Bedding,1\npillow,en,Room,1\n")
    (tmp_path / "i.csv").write_text("term,language,issue_category,sentiment,version\ntight,en,Comfort,negative,1\ntight,en,Room Size,negative,1\n")
    lex = read_lexicons(spark, *(str(tmp_path / f) for f in ("s.csv", "e.csv", "i.csv")))
    assert sorted(map(tuple, lex["sentiment"].collect())) == [("bad", ["negative", "positive"]), ("good", ["positive"])]
    assert lex["entity"].collect()[0].entity == "Bedding"
    assert lex["issue"].collect()[0].issue_category == "Comfort"
    assert [r.row_number for r in scan_lexicon_csv(spark, str(tmp_path / "s.csv"), "sentiment").collect()] == [1, 2, 3, 4]


DEDUP = "review_id string, ingested_at timestamp, row_id string, is_valid boolean, source string, source_id string"


def dedup_rows(spark):
    day = [datetime(2026, 3, d) for d in (1, 2)]
    return spark.createDataFrame([
        ("x", day[0], "r1", True, "s", "1"), ("x", day[1], "r0", True, "s", "1"),
        ("y", day[0], "r2", True, "s", "2"), ("y", day[0], "r3", False, "s", "2"),
        (None, day[0], "r4", False, "", "3"), (None, day[0], "r5", False, "", "3"),
    ], DEDUP)


def test_latest_row_wins_and_rows_without_id_stay(spark):
    assert sorted(r.row_id for r in latest_per_review(dedup_rows(spark)).collect()) == ["r0", "r3", "r4", "r5"]
    preferred = latest_per_review(dedup_rows(spark), prefer_valid=True)
    assert sorted(r.row_id for r in preferred.collect()) == ["r0", "r2", "r4", "r5"]


def test_rank_filter_limits_groups_before_the_shuffle(spark):
    plan = latest_per_review(dedup_rows(spark))._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_identities_repeat_only_before_deduplication(spark):
    rows = dedup_rows(spark)
    assert repeated_identities(rows).count() == 2
    assert repeated_identities(latest_per_review(rows)).count() == 0


REASON = "sentiment_type string, entity string, issue_category string, confidence double, subject array<string>, predicate string, review_id string, reason_id string, run_id string"


def test_reason_gate(spark):
    good = ("negative", "Room", None, 0.5, ["a"], "b", "v", "1", "r")
    bad = [
        (*good[:3], 1.5, *good[4:7], "2", "r"),
        ("neutral", *good[1:7], "3", "r"),
        ("negative", "Attic", "Weather", *good[3:7], "4", "r"),
        (*good[:4], None, "b", None, "5", "r"),
    ]
    entities = spark.createDataFrame([("t", "Room")], "term string, entity string")
    issues = spark.createDataFrame([("t", "Noise")], "term string, issue_category string")
    found = reason_violations(spark.createDataFrame([good, *bad], REASON), entities, issues)
    assert {r.reason_id: r.violations for r in found.collect()} == {
        "2": ["confidence outside 0..1"], "3": ["unknown sentiment"],
        "4": ["unknown entity", "unknown issue"],
        "5": ["an id is missing", "subject is null"],
    }
    assert_reasons(spark.createDataFrame([good], REASON), entities, issues)
    with pytest.raises(ValueError, match="confidence outside 0..1"):
        assert_reasons(spark.createDataFrame(bad[:1], REASON), entities, issues)


def test_partitions_grow_with_the_text_of_reviews(spark):
    """Tokens of a task must stay in memory at any size of the input."""
    reviews = spark.range(64).select(
        F.lit("r").alias("run_id"), F.col("id").cast("string").alias("row_id"), F.lit("v").alias("review_id"),
        F.repeat(F.lit("a b. "), 200_000).alias("review_text"))
    wanted = 64 * 1_000_000 // tokens.PARTITION_TEXT + 1
    assert tokens.partitions_for(reviews) == wanted > int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert tokens.by_review(reviews).rdd.getNumPartitions() == wanted
    few = reviews.limit(1)
    assert tokens.partitions_for(few) == max(4, spark.sparkContext.defaultParallelism)
    assert tokens.partitions_for(few.where("false")) == tokens.partitions_for(few)
