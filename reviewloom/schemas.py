"""Column lists, schemas and fixed labels of the landed tables."""

from __future__ import annotations

from pyspark.sql import types as T

REVIEW_CSV = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("source", "source_id", "review_text", "posted_at", "user_name")]
)

RAW_COLUMNS = [
    "source", "source_id", "review_text", "posted_at", "user_name",
    "source_file", "source_path", "row_number", "row_id", "ingested_at", "run_id",
]
RAW_REQUIRED = ["source_file", "source_path", "row_number", "row_id", "ingested_at", "run_id"]

VALIDATED_COLUMNS = [
    "source", "source_id", "review_text", "posted_at", "posted_at_iso", "user_name",
    "source_file", "source_path", "row_number", "row_id", "review_id", "ingested_at", "is_valid",
    "invalid_reason", "run_id",
]
VALIDATED_REQUIRED = RAW_REQUIRED + ["source", "is_valid", "invalid_reason"]

REASON_COLUMNS = [
    "sentiment_type", "entity", "issue_category", "confidence", "subject", "predicate",
    "review_id", "reason_id", "run_id",
]
REASON_REQUIRED = ["sentiment_type", "confidence", "review_id", "reason_id", "run_id"]

REASON = T.StructType([
    T.StructField("sentiment_type", T.StringType()),
    T.StructField("entity", T.StringType()),
    T.StructField("issue_category", T.StringType()),
    T.StructField("confidence", T.DoubleType()),
    T.StructField("subject", T.ArrayType(T.StringType())),
    T.StructField("predicate", T.StringType()),
    T.StructField("review_id", T.StringType()),
    T.StructField("reason_id", T.StringType()),
    T.StructField("run_id", T.StringType()),
])

TOKEN = T.StructType([
    T.StructField("surface", T.StringType()),
    T.StructField("pos", T.StringType()),
    T.StructField("sub_pos", T.StringType()),
    T.StructField("inflection", T.StringType()),
    T.StructField("lemma", T.StringType()),
    T.StructField("start_offset", T.IntegerType()),
    T.StructField("end_offset", T.IntegerType()),
])

# The messages and labels stored in the tables and matched by the views.
MISSING_ID = "Either source_id or source is missing for review_id generation"
DUPLICATE = "Duplicate review based on source and source_id"
TEXT_NOT_STRING = "review_text is not a string"
TEXT_EMPTY = "review_text is empty"
TEXT_TOO_LONG = "review_text length is too long"
TEXT_TOO_SHORT = "review_text length is too short"
POSTED_MISSING = "posted_at is missing"
POSTED_PARSE_FAILED = "posted_at parse failed"
SENTIMENT_LABELS = ("negative", "positive")
