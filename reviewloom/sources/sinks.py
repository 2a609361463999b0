"""Landing of raw reviews, validated reviews and reasons."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewloom import schemas as S

CSV_OPTIONS = {
    "header": True, "escape": '"', "quoteAll": True, "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False, "timestampFormat": "yyyy-MM-dd'T'HH:mm:ssXXX",
}
REVIEW_RUN = ["review_id", "run_id"]
WRITE_MODES = {"append": "append", "truncate": "overwrite"}


def require_not_null(df: DataFrame, columns: list[str]) -> DataFrame:
    """Fail the write when a required column is NULL, without an extra pass over the data."""
    for name in columns:
        message = F.lit(f"required column {name} is NULL")
        df = df.withColumn(
            name, F.when(F.col(name).isNotNull(), F.col(name)).otherwise(
                F.raise_error(message).cast(df.schema[name].dataType)
            )
        )
    return df


def write_raw(raw: DataFrame, path: str, mode: str = "append", fmt: str = "parquet") -> None:
    rows = require_not_null(raw.select(*S.RAW_COLUMNS), S.RAW_REQUIRED)
    _write(rows, path, mode, fmt)


def write_validated(validated: DataFrame, path: str, mode: str = "append", fmt: str = "parquet") -> None:
    """Day-partitioned by ``posted_at_iso`` and ordered by ``review_id`` within files.

    A single day may hold a large share of all reviews, so days are spread over tasks by
    ``review_id`` rather than gathered whole.
    """
    rows = require_not_null(validated.select(*S.VALIDATED_COLUMNS), S.VALIDATED_REQUIRED)
    if fmt == "csv":
        _write(rows.withColumn("invalid_reason", F.array_join("invalid_reason", ",")), path, mode, fmt)
        return
    daily = (
        rows.withColumn("posted_date", F.to_date("posted_at_iso"))
        .repartitionByRange("posted_date", "review_id", "row_id")
        .sortWithinPartitions("posted_date", "review_id")
    )
    _write(daily, path, mode, fmt, partition_by=["posted_date"])


def write_reasons(reasons: DataFrame, path: str, mode: str = "append", fmt: str = "parquet") -> None:
    """Reasons ranged and ordered by ``review_id``, so that lookups by review prune row groups."""
    rows = require_not_null(reasons.select(*S.REASON_COLUMNS), S.REASON_REQUIRED)
    if fmt == "csv":
        _write(rows.withColumn("subject", F.array_join("subject", ",")), path, mode, fmt)
        return
    _write(rows.repartitionByRange("review_id", "reason_id").sortWithinPartitions("review_id"), path, mode, fmt)


def save_bucketed(
    rows: DataFrame, table: str, buckets: int, mode: str = "append", path: str | None = None
) -> None:
    """A catalog table bucketed by review and run: whatever is grouped or joined by both needs no shuffle.

    Rows are hashed as their buckets are, so that each task writes one file.
    """
    writer = rows.repartition(buckets, *REVIEW_RUN).write.mode(WRITE_MODES[mode]).bucketBy(buckets, *REVIEW_RUN)
    if path:
        writer = writer.option("path", path)
    writer.sortBy(*REVIEW_RUN).saveAsTable(table)


def save_reasons_table(
    reasons: DataFrame, table: str, buckets: int, mode: str = "append", path: str | None = None
) -> None:
    save_bucketed(require_not_null(reasons.select(*S.REASON_COLUMNS), S.REASON_REQUIRED), table, buckets, mode, path)


def _write(rows: DataFrame, path: str, mode: str, fmt: str, partition_by: list[str] | None = None) -> None:
    writer = rows.write.mode(WRITE_MODES[mode]).format(fmt)
    if fmt == "csv":
        writer = writer.options(**CSV_OPTIONS)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
