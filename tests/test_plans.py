"""Plans without needless shuffles, with broadcasts off; gates and native paths."""

import unicodedata

import pytest
from pyspark.sql import functions as F

from reviewloom.functions import text
from reviewloom.operators.extract import extract_pairs, review_pairs
from reviewloom.operators.reasons import build_reasons, distinct_reasons
from reviewloom.operators.validate import gated_reasons
from reviewloom.plans import views
from reviewloom.sources import sinks
from tests.test_extract import GOLDEN, frame


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.fixture(scope="module")
def tokens(spark):
    return frame(spark, {f"{name}{i}": case[0] for name, case in GOLDEN.items() for i in range(3)})


def test_duplicates_go_without_a_shuffle(spark, tokens, tmp_path):
    review_pairs(tokens).write.parquet(str(tmp_path / "pairs"))
    landed = spark.read.parquet(str(tmp_path / "pairs"))
    reasons = build_reasons(landed)
    assert "Exchange" not in plan(reasons)
    by_term = build_reasons(extract_pairs(tokens))
    assert sorted(map(repr, reasons.collect())) == sorted(map(repr, by_term.collect()))
    keys = distinct_reasons(landed).groupBy("row_id", "subject_indices", "predicate_index", "sentiment_type").count()
    assert keys.where("count > 1").isEmpty() and not keys.isEmpty()


def test_bucketed_reviews_and_reasons_meet_without_a_shuffle(spark, tokens, tmp_path, no_broadcast):
    reasons = build_reasons(review_pairs(tokens))
    sinks.save_reasons_table(reasons, "plan_reasons", 4, "truncate", str(tmp_path / "reasons"))
    reviews = reasons.select("review_id", "run_id").distinct().select(
        "*", F.lit(True).alias("is_valid"), F.lit("f").alias("source_file"), F.lit("s").alias("source"),
        F.lit("2026-02-01T00:00:00").alias("posted_at_iso"), F.lit(None).cast("timestamp").alias("ingested_at"),
        F.lit("text").alias("review_text"))
    sinks.save_bucketed(reviews, "plan_reviews", 4, "truncate", str(tmp_path / "reviews"))
    best = views.reasons_top1_per_review(spark.table("plan_reasons"), spark.table("plan_reviews"))
    rows = best.collect()
    assert "Exchange" not in plan(best)
    plain = views.reasons_top1_per_review(reasons, reviews)
    assert sorted(map(repr, rows)) == sorted(map(repr, plain.collect())) and rows


def test_the_gate_observes_the_write(spark, tokens, tmp_path):
    reasons = build_reasons(review_pairs(tokens))
    no_domain = spark.createDataFrame([], "entity string"), spark.createDataFrame([], "issue_category string")
    checked, gate = gated_reasons(reasons, *no_domain)
    checked.write.parquet(str(tmp_path / "good"))
    gate()
    assert checked.columns == reasons.columns
    bad = reasons.withColumn("confidence", F.lit(1.5))
    checked, gate = gated_reasons(bad, *no_domain)
    checked.write.parquet(str(tmp_path / "bad"))
    with pytest.raises(ValueError, match="confidence outside 0..1"):
        gate()


def test_only_texts_that_may_change_go_through_python(spark):
    values = [None, "", "plain é ÿ ʰ", "ｆｕｌｌ", "é", "½", "ĳ", "̈́", "日本", "ﬁ", "á̧", " x", "가", "ŀ"]
    values += [chr(c) for c in range(0x20, 0x300)]
    df = spark.createDataFrame(list(enumerate(values)), "id int, source string").withColumn("extra", F.lit(1))
    folded = text.with_nfkc(df, "source", "folded")
    got = {r.id: r.folded for r in folded.collect()}
    assert got == {i: v if v is None else unicodedata.normalize("NFKC", v) for i, v in enumerate(values)}
    steady = spark.createDataFrame([("abc",), ("Straße",), (None,)], "t string").where(~F.col("t").rlike(text._steady()))
    assert steady.isEmpty()


def test_reasons_are_sorted_by_compiled_comparisons(spark):
    """``array_sort`` compares two structs by an interpreted lambda; ``sort_array`` is compiled, in a column of its own."""
    pairs = spark.createDataFrame(
        [], "run_id string, review_id string, row_id string, pairs array<struct<polarities:array<string>, "
        "subjects:array<struct<index:int,lemma:string,entity:string>>, "
        "predicates:array<struct<index:int,lemma:string,issue_category:string>>>>")
    plan = distinct_reasons(pairs)._jdf.queryExecution().optimizedPlan().toString()
    assert "array_sort(" not in plan
    assert plan.count("sort_array(") == 1 and "explode(filter(found" in plan
