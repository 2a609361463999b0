"""Ingestion metadata: source file, row number, batch instant, row id and run id."""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewloom.functions import ids
from reviewloom.operators.lookups import fits_broadcast
from reviewloom.session import land


def make_run_id(prefix: str = "reviews") -> str:
    """``{prefix}_{UTC instant}_{8 hex digits}``."""
    now = datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%SZ")
    return f"{prefix}_{now}_{uuid.uuid4().hex[:8]}"


def number_rows(scan: DataFrame) -> DataFrame:
    """Add ``source_file``, ``source_path`` and a 1-based ``row_number`` per path to a file scan.

    Rows are counted per scanned file block, the block counts are summed up to block offsets, and
    each row adds its place within the block: no file is ever sorted or gathered in one task. The
    offsets, one row per block, are landed first, so that their size is known before the join.
    """
    rows = scan.select(
        "*",
        F.col("_metadata.file_path").alias("source_path"),
        F.col("_metadata.file_name").alias("source_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_order"),
    )
    blocks = rows.groupBy("source_path", "_block").agg(
        F.count("*").alias("_rows"), F.min("_order").alias("_first")
    )
    before = Window.partitionBy("source_path").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = land(blocks.select(
        "source_path", "_block", "_first", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset")
    ), "block_offsets")
    if fits_broadcast(offsets):
        offsets = F.broadcast(offsets)
    return (
        rows.join(offsets, ["source_path", "_block"])
        .withColumn("row_number", F.col("_offset") + F.col("_order") - F.col("_first") + 1)
        .drop("_block", "_order", "_first", "_offset")
    )


def with_ingest_metadata(
    scan: DataFrame, run_id: str | None = None, ingested_at: datetime | None = None,
    repeatable: bool = False,
) -> DataFrame:
    """Stamp a review scan with its metadata; a scan without row numbers gets them from its files.

    ``repeatable`` derives ``row_id`` from run, path and row number; otherwise it is a random UUID.
    """
    instant = (ingested_at or datetime.now(timezone.utc)).replace(microsecond=0)
    if "row_number" in scan.columns:
        name = F.url_decode(F.replace(F.substring_index("source_path", "/", -1), F.lit("+"), F.lit("%2B")))
        numbered = scan.withColumn("source_file", name)
    else:
        numbered = number_rows(scan)
    stamped = numbered.withColumns({
        "ingested_at": F.lit(instant),
        "run_id": F.lit(run_id or make_run_id()),
    })
    new_id = (
        ids.row_id(F.col("run_id"), F.col("source_path"), F.col("row_number"))
        if repeatable
        else F.uuid()
    )
    return stamped.withColumn("row_id", new_id)
