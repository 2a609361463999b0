"""Data-quality and KPI views over validated reviews, their latest versions, and reasons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reviewloom import schemas as S
from reviewloom.operators.dedup import latest_per_review

RUN = ["run_id", "source_file"]
DAY = [*RUN, "source", "posted_date", "sentiment_type"]


def _rate(part: Column, whole: Column) -> Column:
    return F.try_divide(part, whole)


def dq_metrics_by_run(validated: DataFrame) -> DataFrame:
    """Volumes, validity and defect rates per run and file."""
    reasons = F.coalesce("invalid_reason", F.array().cast("array<string>"))

    def broken(message: str) -> Column:
        return F.array_contains(reasons, message)

    rows = F.count("*")
    valid = F.count_if(F.col("is_valid"))
    failed = F.count_if(broken(S.POSTED_PARSE_FAILED))
    short, long = F.count_if(broken(S.TEXT_TOO_SHORT)), F.count_if(broken(S.TEXT_TOO_LONG))
    duplicate = F.count_if(broken(S.DUPLICATE))
    return validated.groupBy(*RUN).agg(
        F.min("ingested_at").alias("run_started_at"),
        F.max("ingested_at").alias("run_last_seen_at"),
        rows.alias("total_rows"),
        F.count_if(~broken(S.DUPLICATE) & ~broken(S.MISSING_ID)).alias("unique_reviews"),
        valid.alias("rows_valid"),
        F.count_if(~F.col("is_valid")).alias("rows_invalid"),
        _rate(valid, rows).alias("valid_rate"),
        F.count_if(broken(S.MISSING_ID)).alias("missing_source_or_source_id_rows"),
        F.count_if(broken(S.TEXT_EMPTY)).alias("missing_review_text_rows"),
        F.count_if(broken(S.POSTED_MISSING)).alias("missing_posted_at_rows"),
        failed.alias("posted_at_parse_failed_rows"),
        _rate(failed, rows).alias("posted_at_parse_failed_rate"),
        short.alias("too_short_rows"),
        long.alias("too_long_rows"),
        _rate(short + long, rows).alias("length_out_of_range_rate"),
        duplicate.alias("duplicate_rows"),
        _rate(duplicate, rows).alias("duplicate_rate"),
    )


def dq_invalid_reasons_by_run(validated: DataFrame) -> DataFrame:
    """Rows per broken rule, run and file, over all rows including duplicates."""
    return (
        validated.select(*RUN, F.explode("invalid_reason").alias("invalid_reason"))
        .groupBy(*RUN, "invalid_reason")
        .agg(F.count("*").alias("rows_count"))
        .orderBy("run_id", F.desc("rows_count"), "source_file", "invalid_reason")
    )


def _valid_reasons(reasons: DataFrame, dedup: DataFrame) -> DataFrame:
    reviews = dedup.where("is_valid").select(
        "run_id", "review_id", "source_file", "source", "posted_at_iso",
        F.to_date("posted_at_iso").alias("posted_date"), "ingested_at", "review_text",
    )
    return reasons.join(reviews, ["review_id", "run_id"])


def reasons_enriched(reasons: DataFrame, dedup: DataFrame) -> DataFrame:
    """Reasons with the metadata of the latest valid version of their review."""
    return _valid_reasons(reasons, dedup).select(
        "run_id", "source_file", "source", "posted_at_iso", "posted_date", "ingested_at", "review_text",
        "sentiment_type", "entity", "issue_category", "confidence",
        F.array_join("subject", ",").alias("subject"), "predicate", "review_id", "reason_id",
    )


def reasons_top1_per_review(reasons: DataFrame, dedup: DataFrame) -> DataFrame:
    """The most confident reason per run, review and sentiment, ties broken by reason id.

    Reasons are ranked before the join: all reasons of a (review_id, run_id) join the same latest
    row or none, so ranking first gives the same rows and joins one reason per review.
    """
    rank = F.row_number().over(
        Window.partitionBy("run_id", "review_id", "sentiment_type").orderBy(F.desc("confidence"), "reason_id")
    )
    best = reasons.withColumn("_rank", rank).where("_rank = 1").drop("_rank")
    return _valid_reasons(best, dedup).select(
        "run_id", "source_file", "source", "posted_date", "review_text",
        "sentiment_type", "entity", "issue_category", "confidence",
        F.col("subject").alias("subject_array"), F.array_join("subject", ",").alias("subject"),
        "predicate", "review_id", "reason_id",
    )


def _counts(rows: DataFrame, keys: list[str], count: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count("*").alias(count), F.avg("confidence").alias("avg_confidence"))


def kpi_reason_categories_daily(top1: DataFrame) -> DataFrame:
    return top1.groupBy(*DAY, "entity", "issue_category").agg(
        F.count("*").alias("reason_count"),
        # a review has one best reason per run and polarity, and both are part of the key
        F.count("*").alias("review_count"),
        F.avg("confidence").alias("avg_confidence"),
    )


def kpi_entity_counts(top1: DataFrame) -> DataFrame:
    return _counts(top1, [*DAY, "entity"], "review_count")


def kpi_issue_category_counts(top1: DataFrame) -> DataFrame:
    return _counts(top1, [*DAY, "issue_category"], "review_count")


def kpi_top_subject_predicate(top1: DataFrame) -> DataFrame:
    """(subject word, predicate) pairs per day; reasons without a subject drop out."""
    return (
        top1.select(*DAY, "predicate", "review_id", "confidence", F.explode("subject_array").alias("subject_token"))
        .groupBy(*DAY, "subject_token", "predicate")
        .agg(
            F.count("*").alias("pair_count"),
            F.countDistinct("review_id").alias("review_count"),
            F.avg("confidence").alias("avg_confidence"),
        )
    )


def kpi_entity_issue_coverage(top1: DataFrame) -> DataFrame:
    rows = F.count("*")
    entity, issue = F.count("entity"), F.count("issue_category")
    return top1.agg(
        rows.alias("total_records"),
        entity.alias("entity_filled_count"),
        _rate(entity, rows).alias("entity_coverage_rate"),
        issue.alias("issue_category_filled_count"),
        _rate(issue, rows).alias("issue_category_coverage_rate"),
    )


def kpi_extraction_coverage_by_run(dedup: DataFrame, top1: DataFrame) -> DataFrame:
    """How many valid reviews of a run and file have reasons, and categorised negative ones.

    Reasons combine per review first, so that reviews are counted without distinct counts, which
    would multiply the rows.
    """
    negative = F.col("sentiment_type") == "negative"
    valid = dedup.where("is_valid").groupBy(*RUN).agg(F.count("review_id").alias("valid_review_count"))
    per_review = top1.groupBy(*RUN, "review_id").agg(
        F.bool_or(negative).alias("negative"),
        F.count_if(F.col("entity").isNotNull() & negative).alias("entity"),
        F.count_if(F.col("issue_category").isNotNull() & negative).alias("issue"),
    )
    found = per_review.groupBy(*RUN).agg(
        F.count("review_id").alias("any"),
        F.count_if("negative").alias("negative"),
        F.sum("entity").alias("entity"),
        F.sum("issue").alias("issue"),
    )
    whole = F.col("valid_review_count")
    named = {
        "any": ("reviews_with_any_reason", "extraction_coverage_any"),
        "negative": ("reviews_with_negative_reason", "extraction_coverage_negative"),
        "entity": ("entity_filled_count", "entity_coverage_negative"),
        "issue": ("issue_category_filled_count", "issue_category_coverage_negative"),
    }
    columns = []
    for name, (count, rate) in named.items():
        part = F.coalesce(F.col(name), F.lit(0))
        columns += [part.alias(count), _rate(part, whole).alias(rate)]
    return valid.join(found, RUN, "left").select(*RUN, "valid_review_count", *columns)


def top_entities(top1: DataFrame, k: int) -> DataFrame:
    return _top(top1.where(F.col("entity").isNotNull()), ["entity"], k)


def top_issue_categories(top1: DataFrame, k: int) -> DataFrame:
    return _top(top1.where(F.col("issue_category").isNotNull()), ["issue_category"], k)


def top_subject_predicates(top1: DataFrame, k: int) -> DataFrame:
    pairs = top1.select(F.explode("subject_array").alias("subject_token"), "predicate")
    return _top(pairs.where(F.col("predicate").isNotNull()), ["subject_token", "predicate"], k)


def _top(rows: DataFrame, keys: list[str], k: int) -> DataFrame:
    return (
        rows.groupBy(*keys).agg(F.count("*").alias("reason_count"))
        .orderBy(F.desc("reason_count"), *keys).limit(k)
    )


def top_issues_per_entity(top1: DataFrame, k: int) -> DataFrame:
    """The k most frequent issue categories of every entity."""
    counts = (
        top1.where(F.col("entity").isNotNull() & F.col("issue_category").isNotNull())
        .groupBy("entity", "issue_category").agg(F.count("*").alias("reason_count"))
    )
    rank = F.row_number().over(Window.partitionBy("entity").orderBy(F.desc("reason_count"), "issue_category"))
    return counts.withColumn("rank", rank).where(F.col("rank") <= k)


def entity_issue_heatmap(top1: DataFrame, issues: list[str]) -> DataFrame:
    """Reasons per entity (rows) and issue category (columns)."""
    counts = top1.groupBy("entity").pivot("issue_category", issues).count()
    return counts.na.fill(0, issues)


def daily_trend(top1: DataFrame) -> DataFrame:
    return top1.groupBy("posted_date", "sentiment_type").agg(
        F.count("*").alias("reason_count"), F.countDistinct("review_id").alias("review_count")
    )


def run_drilldown(validated: DataFrame, reasons: DataFrame, run_id: str) -> DataFrame:
    """Validated rows of one run with their reasons, for auditing.

    Only valid rows carry reasons. Invalid ones, among them all copies of a review and all rows
    without an id, bypass the join, so that no key of it holds more than one row.
    """
    rows = validated.where(F.col("run_id") == run_id).select(
        "run_id", "source_file", "row_number", "row_id", "review_id", "source", "posted_at_iso",
        "is_valid", F.array_join("invalid_reason", "; ").alias("invalid_reason"),
    )
    found = reasons.where(F.col("run_id") == run_id).select(
        "review_id", "sentiment_type", F.array_join("subject", ",").alias("subject"), "predicate",
        "entity", "issue_category", "confidence", "reason_id",
    )
    audited = rows.where("is_valid").join(found, "review_id", "left")
    return audited.unionByName(rows.where("NOT is_valid"), allowMissingColumns=True)


def register_views(spark: SparkSession, validated: DataFrame, reasons: DataFrame) -> None:
    """Create all views as temporary views, for use from SQL."""
    dedup = latest_per_review(validated)
    top1 = reasons_top1_per_review(reasons, dedup)
    views = {
        "review_validated": validated,
        "review_reasons": reasons,
        "review_validated_dedup": dedup,
        "v_dq_metrics_by_run": dq_metrics_by_run(validated),
        "v_dq_invalid_reasons_by_run": dq_invalid_reasons_by_run(validated),
        "v_reasons_enriched": reasons_enriched(reasons, dedup),
        "v_reasons_top1_per_review": top1,
        "v_kpi_reason_categories_daily": kpi_reason_categories_daily(top1),
        "v_kpi_entity_counts": kpi_entity_counts(top1),
        "v_kpi_issue_category_counts": kpi_issue_category_counts(top1),
        "v_kpi_top_subject_predicate": kpi_top_subject_predicate(top1),
        "v_kpi_entity_issue_coverage": kpi_entity_issue_coverage(top1),
        "v_kpi_extraction_coverage_by_run": kpi_extraction_coverage_by_run(dedup, top1),
    }
    for name, view in views.items():
        view.createOrReplaceTempView(name)
