"""The batch run: ingest, validate, extract, check, land."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from reviewloom import schemas as S
from reviewloom.functions.text import JAPANESE, SPACED, TextProfile
from reviewloom.operators import compounds, tokens
from reviewloom.operators.extract import JAPANESE_RULES, SPACED_RULES, TokenRules, review_pairs
from reviewloom.operators.ingest import make_run_id, with_ingest_metadata
from reviewloom.operators.reasons import build_reasons
from reviewloom.operators.validate import LengthLimits, gated_reasons, validate_reviews
from reviewloom.session import land
from reviewloom.sources import sinks
from reviewloom.sources.reviews_csv import scan_reviews_csv


@dataclass(frozen=True)
class Language:
    """Text profile and tag rules of one language."""

    text: TextProfile = JAPANESE
    rules: TokenRules = JAPANESE_RULES


JAPANESE_LANGUAGE = Language()
SPACED_LANGUAGE = Language(SPACED, SPACED_RULES)


def tokens_from_dictionary(
    valid: DataFrame, dictionary: DataFrame, language: Language = SPACED_LANGUAGE,
    unknown: tokens.UnknownWord = tokens.UnknownWord(),
) -> DataFrame:
    """Tokens of a space-delimited language: words tagged by a POS dictionary."""
    words = tokens.words(tokens.sentences(valid, language.text))
    return tokens.keep_content(tokens.tag_morphemes(words, dictionary, unknown))


def tokens_from_morphemes(valid: DataFrame, morphemes: DataFrame) -> DataFrame:
    """Tokens from an analyser's output: ``row_id, sentence, place`` and tags, delimiters included."""
    return tokens.keep_content(compounds.fold_reviews(morphemes, valid))


def extract_reasons(
    token_rows: DataFrame,
    lexicons: dict[str, DataFrame],
    labels: tuple[str, ...] = S.SENTIMENT_LABELS,
    rules: TokenRules = JAPANESE_RULES,
    random_ids: bool = False,
) -> DataFrame:
    """Tokens to reasons, for the given polarities."""
    merged = land(tokens.merge_lexicons(lexicons, labels), "lexicon")
    return build_reasons(review_pairs(tokens.tag_terms(token_rows, merged), rules), random_ids)


def run(
    spark: SparkSession,
    reviews_path: str | list[str],
    output_dir: str,
    lexicons: dict[str, DataFrame],
    analyse,
    labels: tuple[str, ...] = ("negative",),
    rules: TokenRules = JAPANESE_RULES,
    run_id: str | None = None,
    mode: str = "append",
    fmt: str = "parquet",
    limits: LengthLimits = LengthLimits(),
) -> None:
    """One run from review CSV to the three landed tables.

    ``analyse`` turns valid reviews into tokens, e.g. :func:`tokens_from_dictionary`. Random row ids
    are landed before anything reads them twice, and validated reviews and reasons are read back
    from their tables, so a lost executor never changes an id.
    """
    run_id = run_id or make_run_id()
    batch = f"{output_dir}/_runs/{run_id}"
    stamped = with_ingest_metadata(scan_reviews_csv(spark, reviews_path), run_id)
    stamped.select(*S.RAW_COLUMNS).write.mode("errorifexists").parquet(f"{batch}/raw")
    raw = spark.read.parquet(f"{batch}/raw")
    sinks.write_raw(raw, f"{output_dir}/review_raw", mode, fmt)

    validate_reviews(raw, limits).write.mode("errorifexists").parquet(f"{batch}/validated")
    validated = spark.read.parquet(f"{batch}/validated")
    sinks.write_validated(validated, f"{output_dir}/review_validated", mode, fmt)

    found = extract_reasons(analyse(validated.where("is_valid")), lexicons, labels, rules)
    checked, gate = gated_reasons(found, lexicons["entity"], lexicons["issue"])
    checked.write.mode("errorifexists").parquet(f"{batch}/reasons")
    gate()  # before anything is exported
    reasons = spark.read.parquet(f"{batch}/reasons")
    sinks.write_reasons(reasons, f"{output_dir}/review_reasons", mode, fmt)
