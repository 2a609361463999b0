"""Row validation: identity, text and date rules, and the checks on extracted reasons."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from reviewloom import schemas as S
from reviewloom.functions import ids
from reviewloom.functions.text import strip
from reviewloom.functions.timestamps import posted_at_iso
from reviewloom.operators.lookups import BROADCAST_BYTES, fits_broadcast, hot_key_left_join, lookup
from reviewloom.session import land

# Accepted length of a stripped review text, in code points.
MIN_LENGTH = 5
MAX_LENGTH = 500

_IDENTITY = ["run_id", "source", "source_id"]
_PLACE = ["source_path", "row_number"]


@dataclass(frozen=True)
class LengthLimits:
    shortest: int = MIN_LENGTH
    longest: int = MAX_LENGTH


def standardise(raw: DataFrame, namespace: str = ids.DEFAULT_NAMESPACE) -> DataFrame:
    """Add the deterministic ``review_id`` and the UTC instant ``posted_at_iso``."""
    return raw.withColumns({
        "review_id": ids.review_id(F.col("source"), F.col("source_id"), namespace),
        "posted_at_iso": posted_at_iso(F.col("posted_at")),
    })


def with_first_occurrence(rows: DataFrame, max_broadcast: int = BROADCAST_BYTES) -> DataFrame:
    """Add ``first_row``: the first (path, row number) sharing run, source and source id.

    NULL where the identity is incomplete or occurs once. The first places of repeated identities
    combine map-side and are landed, so that ``rows`` is read for them once and their number is
    known: few are broadcast, many come back through a join that hot identities cannot unbalance.
    """
    complete = ids.has_id(F.col("source"), F.col("source_id"))
    repeated = land(
        rows.where(complete)
        .groupBy(*_IDENTITY)
        .agg(F.min(F.struct(*_PLACE)).alias("first_row"), F.count("*").alias("copies"))
        .where("copies > 1"),
        "repeated_identities",
    )
    firsts = repeated.drop("copies")
    if fits_broadcast(firsts, max_broadcast):
        return rows.join(F.broadcast(firsts), _IDENTITY, "left")
    return hot_key_left_join(rows, firsts, _IDENTITY, repeated, F.struct(*_PLACE), complete)


def text_reason(text: Column, limits: LengthLimits = LengthLimits()) -> Column:
    """The first text rule a review breaks, or NULL; most texts break none and are told first."""
    size = F.length(strip(text))
    return (
        F.when((size >= max(limits.shortest, 1)) & (size <= limits.longest), F.lit(None).cast("string"))
        .when(text.isNull(), S.TEXT_NOT_STRING)
        .when(size == 0, S.TEXT_EMPTY)
        .when(size > limits.longest, S.TEXT_TOO_LONG)
        .when(size < limits.shortest, S.TEXT_TOO_SHORT)
    )


def posted_reason(posted_at: Column, iso: Column) -> Column:
    blank = F.coalesce(strip(posted_at), F.lit("")) == ""
    return F.when(blank, S.POSTED_MISSING).when(iso.isNull(), S.POSTED_PARSE_FAILED)


def identity_reason(source: Column, source_id: Column, place: Column, first_row: Column) -> Column:
    return F.when(~ids.has_id(source, source_id), S.MISSING_ID).when(place > first_row, S.DUPLICATE)


def flag(rows: DataFrame, limits: LengthLimits = LengthLimits()) -> DataFrame:
    """Add sorted ``invalid_reason`` and ``is_valid`` to rows with ids, instants and first occurrences."""
    reasons = F.array(
        identity_reason(F.col("source"), F.col("source_id"), F.struct(*_PLACE), F.col("first_row")),
        text_reason(F.col("review_text"), limits),
        posted_reason(F.col("posted_at"), F.col("posted_at_iso")),
    )
    return rows.withColumn(
        "invalid_reason", F.array_sort(F.array_distinct(F.array_compact(reasons)))
    ).withColumn("is_valid", F.size("invalid_reason") == 0)


def validate_reviews(
    raw: DataFrame, limits: LengthLimits = LengthLimits(), namespace: str = ids.DEFAULT_NAMESPACE
) -> DataFrame:
    """Raw reviews to validated reviews, one to one."""
    return flag(standardise(with_first_occurrence(raw), namespace), limits).select(*S.VALIDATED_COLUMNS)


def split_by_validity(validated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid reviews for extraction, and invalid ones with an empty token array."""
    no_tokens = F.array().cast(f"array<{S.TOKEN.simpleString()}>")
    return validated.where("is_valid"), validated.where("NOT is_valid").withColumn("tokens", no_tokens)


def with_violations(reasons: DataFrame, entity_lexicon: DataFrame, issue_lexicon: DataFrame) -> DataFrame:
    """Extracted reasons with the names of the rules that they break, mostly none.

    Category domains are collapsed to one row per distinct category before the lookup.
    """
    entities = entity_lexicon.select("entity").distinct().withColumn("_entity_known", F.lit(True))
    issues = issue_lexicon.select("issue_category").distinct().withColumn("_issue_known", F.lit(True))
    checked = lookup(reasons, entities, ["entity"], F.col("reason_id"))
    checked = lookup(checked, issues, ["issue_category"], F.col("reason_id"))
    rules = F.array(
        F.when(~F.coalesce(F.col("confidence").between(0, 1), F.lit(False)), "confidence outside 0..1"),
        F.when(
            F.col("reason_id").isNull() | F.col("review_id").isNull() | F.col("run_id").isNull(),
            "an id is missing",
        ),
        F.when(F.col("subject").isNull(), "subject is null"),
        F.when(
            ~F.coalesce(F.col("sentiment_type").isin(*S.SENTIMENT_LABELS), F.lit(False)),
            "unknown sentiment",
        ),
        F.when(F.col("entity").isNotNull() & F.col("_entity_known").isNull(), "unknown entity"),
        F.when(
            F.col("issue_category").isNotNull() & F.col("_issue_known").isNull(),
            "unknown issue",
        ),
    )
    return checked.withColumn("violations", F.array_compact(rules)).select(*reasons.columns, "violations")


def reason_violations(reasons: DataFrame, entity_lexicon: DataFrame, issue_lexicon: DataFrame) -> DataFrame:
    """Extracted reasons that break a rule, with the names of the broken rules."""
    return with_violations(reasons, entity_lexicon, issue_lexicon).where(F.size("violations") > 0)


def gated_reasons(
    reasons: DataFrame, entity_lexicon: DataFrame, issue_lexicon: DataFrame
) -> tuple[DataFrame, Callable[[], None]]:
    """Reasons to be written, and a gate to call after the write.

    The write itself observes how many reasons break a rule, so the gate, which then stops the run, does
    not read them again.
    """
    observed = Observation()
    broken = F.size("violations") > 0
    checked = with_violations(reasons, entity_lexicon, issue_lexicon).observe(
        observed, F.count_if(broken).alias("broken"),
        F.min(F.when(broken, F.concat_ws(": ", "reason_id", F.array_join("violations", ", ")))).alias("first"),
    )

    def gate() -> None:
        if observed.get["broken"]:
            raise ValueError(f"{observed.get['broken']} invalid reasons, first {observed.get['first']}")

    return checked.drop("violations"), gate


def assert_reasons(reasons: DataFrame, entity_lexicon: DataFrame, issue_lexicon: DataFrame) -> None:
    """Stop the run, before anything is exported, if any reason breaks a rule."""
    first = reason_violations(reasons, entity_lexicon, issue_lexicon).select("reason_id", "violations").take(1)
    if first:
        raise ValueError(f"invalid reason {first[0].reason_id}: {', '.join(first[0].violations)}")


def repeated_identities(dedup: DataFrame) -> DataFrame:
    """(source, source_id) pairs occurring more than once among rows with an id; must be empty."""
    return (
        dedup.where(F.col("review_id").isNotNull())
        .groupBy("source", "source_id")
        .agg(F.count("*").alias("rows_count"))
        .where("rows_count > 1")
    )
