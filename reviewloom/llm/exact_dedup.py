"""Exact deduplication by skew-safe combining of whole texts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewloom.llm.common import column, same, text_of, without_spaces


def exact_classes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 16
) -> DataFrame:
    """One row per class of equal texts: ``digest``, ``n_bytes``, ``keep_id``, ``group_size``.

    Texts are equal when they agree after deleting ASCII white space; null counts as empty. Each
    stage groups by the digest *and* the whole normalised text:

    1. every task combines its own rows (the map side of the aggregation),
    2. the tasks' rows are merged per digest and salt (salt: the task's number, so that a hot text
       goes to ``salts`` tasks and each task sends it once),
    3. the at most ``salts`` winners of a class are combined.

    The row with the most code points in its original text stays; among equals the smallest id,
    and a null id last.
    """
    body = without_spaces(text_of(docs, text_col))
    key = column(docs, id_col)
    rank = F.struct(
        (-F.length(text_of(docs, text_col))).alias("longest"),
        key.isNull().alias("no_id"),
        key.alias("keep_id"),
    )
    rows = docs.select(body.alias("body"), rank.alias("rank")).select(
        F.unhex(F.sha2("body", 256)).alias("digest"),
        "body",
        "rank",
        F.pmod(F.spark_partition_id(), F.lit(salts)).alias("salt"),
    )
    merged = rows.groupBy("digest", "body", "salt").agg(
        F.min("rank").alias("rank"), F.count("*").alias("group_size")
    )
    winners = merged.groupBy("digest", "body").agg(
        F.min("rank").alias("rank"), F.sum("group_size").alias("group_size")
    )
    return winners.select(
        "digest",
        F.octet_length("body").alias("n_bytes"),
        F.col("rank.keep_id").alias("keep_id"),
        "group_size",
    )


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 16
) -> DataFrame:
    """Per row of ``docs``: id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Rows without a copy are decided by the absence of a class of two or more, so only narrow rows
    of such classes are joined back, by digest and length; the join is one that adaptive execution
    splits when a class is hot. Rows repeated with the same id all count and are all marked kept
    when their id is the one that stays. A null id is compared as a value of its own. An empty
    table gives no rows; other columns are not read.
    """
    body = without_spaces(text_of(docs, text_col))
    rows = docs.select(column(docs, id_col).alias("id"), body.alias("body")).select(
        "id",
        F.unhex(F.sha2("body", 256)).alias("digest"),
        F.octet_length("body").alias("n_bytes"),
    )
    copies = exact_classes(docs, id_col, text_col, salts).where("group_size > 1").alias("c")
    joined = rows.alias("r").join(
        copies,
        (F.col("r.digest") == F.col("c.digest")) & (F.col("r.n_bytes") == F.col("c.n_bytes")),
        "left",
    )
    alone = F.col("c.group_size").isNull()
    keep = F.when(alone, F.col("r.id")).otherwise(F.col("c.keep_id"))
    return joined.select(
        F.col("r.id").alias(id_col),
        keep.alias("keep_id"),
        F.coalesce(F.col("c.group_size"), F.lit(1).cast("long")).alias("group_size"),
        same(F.col("r.id"), keep).alias("kept"),
        F.lower(F.hex("r.digest")).alias("text_sha256"),
    )
