"""Column helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reviewloom.session import land

#: The six ASCII white space characters, [\x20\x09-\x0D].
SPACES = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


def column(df: DataFrame, name: str) -> Column:
    """The column of exactly this name, dots and all."""
    return df["`" + name.replace("`", "``") + "`"]


def text_of(df: DataFrame, name: str) -> Column:
    """The text, with null as empty."""
    return F.coalesce(column(df, name).cast("string"), F.lit(""))


def without_spaces(text: Column) -> Column:
    return reduce(lambda c, space: F.replace(c, F.lit(space), F.lit("")), SPACES, text)


def ascii_lower(text: Column) -> Column:
    """A-Z lowered, all else as it is (``lower`` would change other letters too)."""
    return F.translate(text, UPPER, LOWER)


def spaced_words(text: Column) -> Column:
    """Array of the maximal runs of characters that are not ASCII white space."""
    return F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")


def same(left: Column, right: Column) -> Column:
    return left.eqNullSafe(right)


@contextmanager
def text_batches(spark: SparkSession, rows: int = 1_000) -> Iterator[None]:
    """Fewer rows per Arrow batch for the actions inside: texts are long, and a batch is held by the
    JVM and by Python at once."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def running_total(
    df: DataFrame, group: list[str], order: list[str], value: str, before: str
) -> DataFrame:
    """Add ``before``: the sum of ``value`` over the rows of the same group that sort earlier.

    A hot group is never gathered: rows are range-partitioned by group *and* order, landed with
    their part number, summed within each part, and shifted by the totals of the earlier parts
    (one row per part and group). Rows equal in ``order`` must be interchangeable; the sums do not
    depend on where the parts were cut.
    """
    part = "__part"
    sorted_rows = land(
        df.repartitionByRange(*group, *order).withColumn(part, F.spark_partition_id()), "parts"
    )
    totals = sorted_rows.groupBy(*group, part).agg(F.sum(value).alias("__sum"))
    earlier = Window.partitionBy(*group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *[F.col(c).alias(f"__g{i}") for i, c in enumerate(group)],
        F.col(part).alias("__at"),
        F.coalesce(F.sum("__sum").over(earlier), F.lit(0)).alias("__offset"),
    )
    within = (
        Window.partitionBy(*group, part).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    )
    inside = sorted_rows.withColumn("__inside", F.coalesce(F.sum(value).over(within), F.lit(0)))
    on = [same(F.col(c), F.col(f"__g{i}")) for i, c in enumerate(group)]
    return (
        inside.join(offsets, [*on, F.col(part) == F.col("__at")])
        .withColumn(before, F.col("__inside") + F.col("__offset"))
        .drop(*[f"__g{i}" for i in range(len(group))], "__at", "__offset", "__inside", part)
    )
