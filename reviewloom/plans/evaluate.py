"""Extraction quality against hand-made labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _judged(valid: DataFrame, top1: DataFrame, gold: DataFrame) -> DataFrame:
    """Labelled valid rows with their canonical reason; one row per ``(run_id, review_id)``."""
    found = top1.select("run_id", "review_id", F.col("entity"), F.col("issue_category"), F.lit(True).alias("found"))
    return (
        valid.select("run_id", "review_id")
        .join(gold, ["run_id", "review_id"])
        .join(found, ["run_id", "review_id"], "left")
    )


def extraction_quality(valid: DataFrame, top1: DataFrame, gold: DataFrame) -> DataFrame:
    """Coverage over labelled reviews; precision and category accuracy over those with a reason.

    ``gold`` has one row per ``(run_id, review_id)``: ``is_correct``, ``gold_entity``, ``gold_issue``.
    """
    found = F.count("found")
    hit = F.col("found").isNotNull()
    return _judged(valid, top1, gold).agg(
        F.count("*").alias("labelled_reviews"),
        found.alias("extracted_reviews"),
        F.try_divide(found, F.count("*")).alias("extraction_coverage"),
        F.try_divide(F.count_if(hit & F.col("is_correct")), found).alias("extraction_precision"),
        F.try_divide(F.count_if(F.col("entity") == F.col("gold_entity")), found).alias("entity_accuracy"),
        F.try_divide(F.count_if(F.col("issue_category") == F.col("gold_issue")), found).alias("issue_accuracy"),
    )


def per_label_quality(valid: DataFrame, top1: DataFrame, gold: DataFrame, label: str) -> DataFrame:
    """Precision, recall and support per label; ``label`` is ``entity`` or ``issue_category``.

    Rows combine to (given, expected) pairs first; only those few counts are split by label.
    """
    expected = {"entity": "gold_entity", "issue_category": "gold_issue"}[label]
    pairs = (
        _judged(valid, top1, gold)
        .groupBy(F.col(label).alias("given"), F.col(expected).alias("expected"))
        .agg(F.count("*").alias("n"))
    )
    sides = pairs.select(
        "n", (F.col("given").eqNullSafe(F.col("expected"))).alias("right"),
        F.explode(F.array(
            F.struct(F.col("given").alias("label"), F.lit("given").alias("side")),
            F.struct(F.col("expected").alias("label"), F.lit("expected").alias("side")),
        )).alias("x"),
    )
    given = F.sum(F.when(F.col("x.side") == "given", F.col("n")).otherwise(0))
    support = F.sum(F.when(F.col("x.side") == "expected", F.col("n")).otherwise(0))
    right = F.sum(F.when((F.col("x.side") == "given") & F.col("right"), F.col("n")).otherwise(0))
    return (
        sides.where("x.label IS NOT NULL").groupBy(F.col("x.label").alias("label")).agg(
            support.alias("support"),
            given.alias("predicted"),
            F.try_divide(right, given).alias("label_precision"),
            F.try_divide(right, support).alias("label_recall"),
        )
    )
