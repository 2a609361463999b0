"""Steps within a review's arrays: values by name, choices, folding of width."""

from pyspark.sql import functions as F

from reviewloom.functions import arrays, text
from reviewloom.operators.extract import review_pairs
from tests.test_extract import GOLDEN, frame


def test_pairs_are_not_copied_at_every_step(spark):
    """A transform copies what it holds, and array_sort evaluates its comparison as an expression."""
    plan = review_pairs(frame(spark, {"r": GOLDEN["narrow_window"][0]}))._jdf.queryExecution().optimizedPlan().toString()
    assert "transform(array(" not in plan and "array_sort(" not in plan


def test_a_named_value_may_be_null_and_nested(spark):
    row = spark.sql("SELECT 2 AS a, CAST(NULL AS int) AS b").select(
        arrays.let(F.col("a") + 1, lambda x: arrays.let(F.array(x, x), lambda y: F.size(y) * x)).alias("nested"),
        arrays.let(F.col("b"), lambda x: F.coalesce(x, F.lit(-1))).alias("null"),
        arrays.choose([(F.col("b") > 0, F.lit("b")), (F.col("a") > 1, F.lit("a"))], F.lit("none")).alias("second"),
        arrays.choose([(F.col("a") > 2, F.lit("a"))], F.lit("none")).alias("last"),
        arrays.either(F.col("b") > 0, F.col("a")).alias("missing"),
    ).first()
    assert tuple(row) == (6, -1, "a", "none", None)


def test_texts_fold_alike_with_and_without_full_width(spark):
    rows = spark.createDataFrame([("One. TWO!? three",), ("Ｏｎｅ. ＴＷＯ!? three",), ("a｜b|c",), (None,)], "t string")
    found = [r[0] for r in rows.select(text.normalise(F.col("t"), text.SPACED)).collect()]
    assert found == ["one| two| three", "one| two| three", "a|b|c", None]
