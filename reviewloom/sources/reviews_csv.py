"""CSV sources for reviews and dictionaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom import schemas as S
from reviewloom.operators.ingest import number_rows
from reviewloom.operators.lookups import first_per_key
from reviewloom.sources.csv_records import read_records

LEXICONS = {
    "sentiment": ("term", "polarity", "language"),
    "entity": ("term", "language", "entity", "version"),
    "issue": ("term", "language", "issue_category", "sentiment", "version"),
    "synonym": ("lemma", "pos", "synonym"),
}


def scan_reviews_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Headered UTF-8 review CSV: quoted line breaks allowed, blank lines skipped, surplus fields dropped.

    Returns the fields with ``source_path`` and ``row_number``. A large file is read by many tasks, line
    breaks inside quotes or not (see ``csv_records``); Spark's own parser then takes each record apart.
    An empty field is an empty text; only a field missing at the end of its row is NULL. Spark reads
    both as NULL, so rows of another length, which it keeps as malformed, tell them apart by the
    number of separators outside quotes.
    """
    names = S.REVIEW_CSV.fieldNames()
    schema = ", ".join(f"{name} string" for name in [*names, "_malformed"])
    options = {"escape": '"', "multiLine": "true", "columnNameOfCorruptRecord": "_malformed", "mode": "PERMISSIVE"}
    rows = read_records(spark, path).withColumn("fields", F.from_csv("record", schema, options))
    malformed = F.col("fields._malformed")
    separators = F.length(F.regexp_replace(F.regexp_replace(malformed, r'"[^"]*+(?:""[^"]*+)*+"', ""), "[^,]", ""))
    fields = F.coalesce(separators + 1, F.lit(len(names)))
    return rows.select("source_path", "row_number", *[
        F.when(fields > i, F.coalesce(F.col(f"fields.{c}"), F.lit(""))).alias(c) for i, c in enumerate(names)
    ])


def scan_lexicon_csv(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """A dictionary CSV as rows in file order (column ``row_number``)."""
    schema = ", ".join(f"{c} string" for c in LEXICONS[kind])
    return number_rows(spark.read.csv(path, schema=schema, header=True, escape='"')).drop("source_file", "source_path")


def read_lexicons(spark: SparkSession, sentiment: str, entity: str, issue: str) -> dict[str, DataFrame]:
    """The three dictionaries, ready for lookups by term."""
    return {
        "sentiment": polarities(scan_lexicon_csv(spark, sentiment, "sentiment")),
        "entity": first_per_key(scan_lexicon_csv(spark, entity, "entity"), ["term"], "entity", ["row_number"]),
        "issue": first_per_key(scan_lexicon_csv(spark, issue, "issue"), ["term"], "issue_category", ["row_number"]),
    }


def polarities(lexicon: DataFrame) -> DataFrame:
    """One row per term with its sorted set of polarities."""
    return (
        lexicon.where(F.col("polarity").isin(*S.SENTIMENT_LABELS))
        .groupBy("term")
        .agg(F.array_sort(F.collect_set("polarity")).alias("polarities"))
    )
