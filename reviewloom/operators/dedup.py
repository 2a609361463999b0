"""Latest row per review across runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_per_review(validated: DataFrame, prefer_valid: bool = False) -> DataFrame:
    """Keep the latest row per ``review_id`` and every row without one.

    The rank-1 filter lets Spark keep one row per id in every map task before the shuffle, so an
    id with very many copies does not overload its reducer. Rows without an id are never shuffled.
    ``prefer_valid`` ranks valid rows first.
    """
    latest = [F.col("ingested_at").desc(), F.col("row_id").desc()]
    if prefer_valid:
        latest.insert(0, F.col("is_valid").desc())
    rank = F.row_number().over(Window.partitionBy("review_id").orderBy(*latest))
    with_id = (
        validated.where(F.col("review_id").isNotNull())
        .withColumn("_rank", rank)
        .where("_rank = 1")
        .drop("_rank")
    )
    return with_id.unionByName(validated.where(F.col("review_id").isNull()))
