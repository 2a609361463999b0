"""Named queries over the given tables, built from the operators and landed stages."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewloom import schemas as S
from reviewloom.functions import text
from reviewloom.operators import compounds, dedup, extract, ingest, reasons, tokens, validate
from reviewloom.operators.lookups import last_per_key
from reviewloom.plans import batch, evaluate, views
from reviewloom.session import stage, stage_path, table_stage, wide_rows
from reviewloom.sources import driver_tables as tables
from reviewloom.sources import reviews_csv, sinks

Query = Callable[[SparkSession, str], DataFrame]
TOP_K = 10


def portable(df: DataFrame) -> DataFrame:
    """Render instants, dates and arrays as text and round fractions, for comparison across engines."""
    columns = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.TimestampType):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSS")
        elif isinstance(field.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(field.dataType, T.ArrayType):
            c = F.array_join(c.cast("array<string>"), ",")
        elif isinstance(field.dataType, T.DoubleType):
            c = F.round(c, 6)
        columns.append(c.alias(field.name))
    return df.select(*columns)


# --- stages -----------------------------------------------------------------------------------


def validated(spark: SparkSession, sf: str) -> DataFrame:
    return stage(spark, sf, "validated", lambda: validate.validate_reviews(tables.raw_reviews(spark, sf)))


def valid(spark: SparkSession, sf: str) -> DataFrame:
    """What the text queries read: reviews of any length, as the length rule only flags them here."""
    others = F.array_remove("invalid_reason", S.TEXT_TOO_LONG)
    return validated(spark, sf).where(F.size(others) == 0)


def latest(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.latest_per_review(validated(spark, sf))


def lexicons(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    built = None

    def one(kind: str) -> DataFrame:
        nonlocal built
        built = built or tables.lexicons(spark, sf)
        return built[kind]

    return {k: stage(spark, sf, f"lexicon_{k}", lambda k=k: one(k)) for k in ("sentiment", "entity", "issue")}


def morphs(spark: SparkSession, sf: str) -> DataFrame:
    return stage(spark, sf, "lexicon_morph", lambda: tables.morph_dictionary(spark, sf))


def synonyms(spark: SparkSession, sf: str) -> DataFrame:
    return stage(
        spark, sf, "lexicon_synonym",
        lambda: last_per_key(tables.synonym_rows(spark, sf), ["lemma", "pos"], "synonym", ["item_id", "place"]),
    )


def token_rows(spark: SparkSession, sf: str, language: batch.Language = batch.SPACED_LANGUAGE) -> DataFrame:
    return batch.tokens_from_dictionary(valid(spark, sf), morphs(spark, sf), language, tables.UNKNOWN)


def tagged_rows(spark: SparkSession, sf: str, language: batch.Language = batch.SPACED_LANGUAGE) -> DataFrame:
    merged = stage(
        spark, sf, "lexicon_merged", lambda: tokens.merge_lexicons(lexicons(spark, sf), S.SENTIMENT_LABELS))
    return tokens.tag_terms(token_rows(spark, sf, language), merged)


def review_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """A row per review, so that its reasons need no shuffle."""
    return stage(
        spark, sf, "pairs",
        lambda: extract.review_pairs(tagged_rows(spark, sf), batch.SPACED_LANGUAGE.rules),
    )


def pair_rows(spark: SparkSession, sf: str) -> DataFrame:
    return extract.explode_pairs(review_pairs(spark, sf))


def _buckets(spark: SparkSession, sf: str) -> int:
    return tokens.partitions_for(valid(spark, sf))


def reason_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Reasons, bucketed like the valid reviews that they are joined with."""
    def write(table: str, path: str) -> None:
        made = reasons.build_reasons(review_pairs(spark, sf))
        with wide_rows(spark):
            sinks.save_reasons_table(made, table, _buckets(spark, sf), "truncate", path)

    return table_stage(spark, sf, "reasons", write)


def latest_valid(spark: SparkSession, sf: str) -> DataFrame:
    """Latest versions of reviews, of valid ones: invalid rows may lack the id that rows are hashed by."""
    return table_stage(spark, sf, "latest_valid", lambda table, path: sinks.save_bucketed(
        latest(spark, sf).where("is_valid"), table, _buckets(spark, sf), "truncate", path))


def top1(spark: SparkSession, sf: str) -> DataFrame:
    return stage(
        spark, sf, "top1",
        lambda: views.reasons_top1_per_review(reason_rows(spark, sf), latest_valid(spark, sf)),
    )


# --- sources and sinks --------------------------------------------------------------------------


def ingest_metadata(spark: SparkSession, sf: str) -> DataFrame:
    return tables.raw_reviews(spark, sf).select("run_id", "source_file", "source_path", "row_number", "ingested_at", "row_id")


def csv_scan(spark: SparkSession, sf: str) -> DataFrame:
    """All raw reviews written as CSV files, scanned back, numbered and stamped."""
    path = stage_path(spark, sf, "review_csv")
    columns = S.REVIEW_CSV.fieldNames()
    (
        tables.raw_reviews(spark, sf).select(*columns).na.fill("").write.mode("overwrite")
        .options(**sinks.CSV_OPTIONS).csv(path)
    )
    scanned = ingest.with_ingest_metadata(reviews_csv.scan_reviews_csv(spark, path), "run_csv", repeatable=True)
    per_file = scanned.groupBy("source_path").agg(
        F.count("*").alias("n"),
        F.max("row_number").alias("last"),
        F.sum("row_number").alias("total"),
        F.count_if(F.col("source_id") == "").alias("no_id"),
        F.sum(F.length("review_text")).alias("chars"),
    )
    return per_file.agg(
        F.sum("n").alias("rows_read"),
        F.sum("last").alias("rows_numbered"),
        F.count_if(F.col("total") != F.col("n") * (F.col("n") + 1) / 2).alias("misnumbered_files"),
        F.sum("no_id").alias("rows_without_source_id"),
        F.sum("chars").alias("text_chars"),
    )


def raw_table(spark: SparkSession, sf: str) -> DataFrame:
    path = stage_path(spark, sf, "review_raw")
    sinks.write_raw(tables.raw_reviews(spark, sf), path, "truncate")
    return spark.read.parquet(path).select(
        "run_id", "row_id", "source_path", "row_number", "source", "source_id", F.md5("review_text").alias("text_md5"), "posted_at", "user_name"
    )


def validated_table_days(spark: SparkSession, sf: str) -> DataFrame:
    path = stage_path(spark, sf, "review_validated")
    sinks.write_validated(validated(spark, sf), path, "truncate")
    return spark.read.parquet(path).groupBy("posted_date").agg(
        F.count("*").alias("rows_count"), F.count_if("is_valid").alias("valid_rows"),
        F.min("review_id").alias("first_review_id"), F.max("review_id").alias("last_review_id"),
    )


def reasons_table(spark: SparkSession, sf: str) -> DataFrame:
    path = stage_path(spark, sf, "review_reasons")
    sinks.write_reasons(reason_rows(spark, sf), path, "truncate")
    return spark.read.schema(S.REASON).parquet(path)


def lexicon_entries(spark: SparkSession, sf: str) -> DataFrame:
    lex = lexicons(spark, sf)
    return (
        lex["sentiment"].select(F.lit("sentiment").alias("kind"), "term", F.array_join("polarities", ",").alias("value"))
        .unionByName(lex["entity"].select(F.lit("entity").alias("kind"), "term", F.col("entity").alias("value")))
        .unionByName(lex["issue"].select(F.lit("issue").alias("kind"), "term", F.col("issue_category").alias("value")))
    )


def synonym_entries(spark: SparkSession, sf: str) -> DataFrame:
    return synonyms(spark, sf)


# --- review level -------------------------------------------------------------------------------


def review_ids(spark: SparkSession, sf: str) -> DataFrame:
    return validate.standardise(tables.raw_reviews(spark, sf)).select("row_id", "source", "source_id", "review_id")


def posted_timestamps(spark: SparkSession, sf: str) -> DataFrame:
    rows = validate.standardise(tables.raw_reviews(spark, sf))
    return rows.select("row_id", "posted_at", "posted_at_iso", F.to_date("posted_at_iso").alias("posted_date"))


def validation_flags(spark: SparkSession, sf: str) -> DataFrame:
    return validate.validate_reviews(tables.raw_reviews(spark, sf)).select("row_id", "review_id", "is_valid", "invalid_reason")


def validity_split(spark: SparkSession, sf: str) -> DataFrame:
    good, bad = validate.split_by_validity(validated(spark, sf))
    rows = F.count("*").alias("rows_count")
    return (
        good.groupBy("run_id", "source").agg(rows, F.lit(0).cast("long").alias("token_slots"), F.lit(True).alias("valid"))
        .unionByName(bad.groupBy("run_id", "source").agg(
            rows, F.sum(F.size("tokens")).alias("token_slots"), F.lit(False).alias("valid")))
    )


def reason_violations(spark: SparkSession, sf: str) -> DataFrame:
    """The gate after one entity category is retired: reasons still using it are the violations."""
    lex = lexicons(spark, sf)
    kept = lex["entity"].where(F.col("entity") != tables.ENTITIES[0])
    return validate.reason_violations(reason_rows(spark, sf), kept, lex["issue"]).select("reason_id", "entity", "violations")


def repeated_identities(spark: SparkSession, sf: str) -> DataFrame:
    """Identities repeated before and (never) after deduplication."""
    before = validate.repeated_identities(validated(spark, sf)).withColumn("stage", F.lit("validated"))
    after = validate.repeated_identities(latest(spark, sf)).withColumn("stage", F.lit("deduplicated"))
    return before.unionByName(after)


def latest_reviews(spark: SparkSession, sf: str) -> DataFrame:
    return latest(spark, sf).select("row_id", "review_id", "run_id", "is_valid", "ingested_at")


# --- text and tokens ----------------------------------------------------------------------------


def normalised_text(spark: SparkSession, sf: str) -> DataFrame:
    """Default delimiters, native width folding and lower case over every line."""
    profile = text.TextProfile(full_nfkc=False, orthography=False)
    return tables.raw_reviews(spark, sf).select("row_id", text.normalise(F.col("review_text"), profile).alias("normalised"))


def compatibility_forms(spark: SparkSession, sf: str) -> DataFrame:
    """Full NFKC, in Arrow batches where a text may change."""
    rows = tables.raw_reviews(spark, sf).select("row_id", "review_text")
    return text.with_nfkc(rows, "review_text", "folded").select("row_id", "folded")


def orthographic_forms(spark: SparkSession, sf: str) -> DataFrame:
    return tables.raw_reviews(spark, sf).select("row_id", text.orthography(F.col("review_text")).alias("unified"))


def sentence_rows(spark: SparkSession, sf: str) -> DataFrame:
    return tokens.sentences(valid(spark, sf), text.SPACED).select("row_id", "sentence", F.col("text").alias("sentence_text"))


def word_tokens(spark: SparkSession, sf: str) -> DataFrame:
    return token_rows(spark, sf).select(
        "row_id", "sentence", "index", "index_in_sentence", "surface", "pos", "sub_pos", "inflection", "lemma"
    )


def polarity_tokens(spark: SparkSession, sf: str) -> DataFrame:
    wanted = F.array(F.lit("negative"))
    tagged = tokens.tag_polarity(token_rows(spark, sf), lexicons(spark, sf)["sentiment"], wanted)
    return tagged.select("row_id", "index", "lemma", F.try_element_at("polarities", F.lit(1)).alias("sentiment"))


def synonym_tokens(spark: SparkSession, sf: str) -> DataFrame:
    return tokens.tag_synonym(token_rows(spark, sf), synonyms(spark, sf)).select("row_id", "index", "lemma", "pos", "synonym")


def category_tokens(spark: SparkSession, sf: str) -> DataFrame:
    lex = lexicons(spark, sf)
    tagged = tokens.tag_categories(token_rows(spark, sf), lex["entity"], lex["issue"])
    return tagged.select("row_id", "index", "lemma", "entity", "issue_category")


def compound_tokens(spark: SparkSession, sf: str) -> DataFrame:
    """Words folded from the morphemes of every valid review, with offsets."""
    dictionary = stage(
        spark, sf, "lexicon_compound", lambda: tables.morph_dictionary(spark, sf, tables.COMPOUND_CLASSES))
    morphemes = tokens.tag_morphemes(tokens.morphemes(valid(spark, sf), text.SPACED), dictionary, tables.UNKNOWN)
    return compounds.fold_reviews(morphemes).select(
        "row_id", "sentence", "place", "surface", "pos", "sub_pos", "inflection", "lemma", "start_offset", "end_offset"
    )


# --- extraction ---------------------------------------------------------------------------------


def subject_islands(spark: SparkSession, sf: str) -> DataFrame:
    """Subject nouns with the position of the first noun they belong together with."""
    found = extract.find_nouns(extract.gather(tagged_rows(spark, sf), batch.SPACED_LANGUAGE.rules))
    noun = found.select("row_id", F.explode_outer("nouns").alias("noun")).where("noun IS NOT NULL")
    return noun.select("row_id", "noun.sentence", "noun.index", "noun.nth", "noun.island")


def _pairs(df: DataFrame) -> DataFrame:
    return df.select(
        "row_id", "term_index", "term", "rule",
        F.transform("subjects", lambda s: s["index"]).alias("subjects"),
        F.array_sort(F.transform("predicates", lambda p: p["index"])).alias("predicates"),
    )


def term_pairs(*rules: str) -> Query:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        return _pairs(pair_rows(spark, sf).where(F.col("rule").isin(*rules)))

    return query


def term_pairs_default_split(spark: SparkSession, sf: str) -> DataFrame:
    """Extraction with the default delimiters, where every space ends a sentence."""
    profile = text.TextProfile(full_nfkc=False, orthography=False)
    language = batch.Language(profile, batch.SPACED_LANGUAGE.rules)
    return _pairs(extract.extract_pairs(tagged_rows(spark, sf, language), language.rules))


def split_reasons(spark: SparkSession, sf: str) -> DataFrame:
    """One row per term, polarity and predicate, counted before duplicates collapse."""
    return reasons.split_predicates(pair_rows(spark, sf)).groupBy("row_id", "sentiment_type").agg(
        F.count("*").alias("reason_rows"), F.count("predicate").alias("with_predicate"),
        F.count_if(F.size("subjects") > 0).alias("with_subject"),
    )


def distinct_reasons(spark: SparkSession, sf: str) -> DataFrame:
    kept = reasons.distinct_reasons(review_pairs(spark, sf))
    distance = reasons.nearest_distance(F.col("subject_indices"), F.col("predicate_index"))
    # a name used inside a lambda must not be given anew in the same select: it would mean the new one
    kept = kept.select("row_id", "sentiment_type", "subject_indices", "predicate_index", distance.alias("distance"))
    return kept.na.fill(-1, ["predicate_index", "distance"])


def reason_records(spark: SparkSession, sf: str) -> DataFrame:
    return reason_rows(spark, sf)


# --- views --------------------------------------------------------------------------------------


def over_validated(view: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf: view(validated(spark, sf))


def over_top1(view: Callable[..., DataFrame], *args) -> Query:
    return lambda spark, sf: view(top1(spark, sf), *args)


def reasons_enriched(spark: SparkSession, sf: str) -> DataFrame:
    return views.reasons_enriched(reason_rows(spark, sf), latest_valid(spark, sf))


def reasons_top1(spark: SparkSession, sf: str) -> DataFrame:
    return views.reasons_top1_per_review(reason_rows(spark, sf), latest_valid(spark, sf))


def extraction_coverage(spark: SparkSession, sf: str) -> DataFrame:
    return views.kpi_extraction_coverage_by_run(latest(spark, sf), top1(spark, sf))


def run_drilldown(spark: SparkSession, sf: str) -> DataFrame:
    return views.run_drilldown(validated(spark, sf), reason_rows(spark, sf), "run_b")


def gold(spark: SparkSession, sf: str) -> DataFrame:
    """Labels of documents as labels of their lines' latest valid reviews."""
    labels = tables.table(spark, sf, "labels").select(
        "doc_id", (F.col("quality") == 1).alias("is_correct"),
        tables.pick(tables.ENTITIES, F.substring(F.md5(F.col("doc_id").cast("string")), 2, 1)).alias("gold_entity"),
        tables.pick(tables.ISSUES, F.substring(F.md5(F.col("doc_id").cast("string")), 3, 1)).alias("gold_issue"),
    )
    rows = latest_valid(spark, sf).select(
        "run_id", "review_id", F.substring_index("source_path", "/", -1).cast("long").alias("doc_id"))
    return rows.join(labels, "doc_id").drop("doc_id")


def _canonical(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    negative = top1(spark, sf).where(F.col("sentiment_type") == "negative")
    return latest_valid(spark, sf), negative, gold(spark, sf)


def extraction_quality(spark: SparkSession, sf: str) -> DataFrame:
    return evaluate.extraction_quality(*_canonical(spark, sf))


def entity_quality(spark: SparkSession, sf: str) -> DataFrame:
    return evaluate.per_label_quality(*_canonical(spark, sf), "entity")


def issue_quality(spark: SparkSession, sf: str) -> DataFrame:
    return evaluate.per_label_quality(*_canonical(spark, sf), "issue_category")


QUERIES: dict[str, Query] = {
    "ingest_metadata": ingest_metadata,
    "csv_scan": csv_scan,
    "raw_table": raw_table,
    "validated_table_days": validated_table_days,
    "reasons_table": reasons_table,
    "lexicon_entries": lexicon_entries,
    "synonym_entries": synonym_entries,
    "review_ids": review_ids,
    "posted_timestamps": posted_timestamps,
    "validation_flags": validation_flags,
    "validity_split": validity_split,
    "reason_violations": reason_violations,
    "repeated_identities": repeated_identities,
    "latest_reviews": latest_reviews,
    "dq_metrics_by_run": over_validated(views.dq_metrics_by_run),
    "dq_invalid_reasons_by_run": over_validated(views.dq_invalid_reasons_by_run),
    "normalised_text": normalised_text,
    "compatibility_forms": compatibility_forms,
    "orthographic_forms": orthographic_forms,
    "sentence_rows": sentence_rows,
    "word_tokens": word_tokens,
    "polarity_tokens": polarity_tokens,
    "synonym_tokens": synonym_tokens,
    "category_tokens": category_tokens,
    "compound_tokens": compound_tokens,
    "subject_islands": subject_islands,
    "noun_term_pairs": term_pairs("noun_then_predicate", "noun_as_predicate", "noun_alone"),
    "modifier_term_pairs": term_pairs("modifier"),
    "own_sentence_pairs": term_pairs("subject_before", "subject_after"),
    "merged_sentence_pairs": term_pairs("earlier_sentence", "later_sentence", "no_subject"),
    "term_pairs_default_split": term_pairs_default_split,
    "split_reasons": split_reasons,
    "distinct_reasons": distinct_reasons,
    "reason_records": reason_records,
    "reasons_enriched": reasons_enriched,
    "best_reason_per_review": reasons_top1,
    "kpi_reason_categories_daily": over_top1(views.kpi_reason_categories_daily),
    "kpi_entity_counts": over_top1(views.kpi_entity_counts),
    "kpi_issue_category_counts": over_top1(views.kpi_issue_category_counts),
    "kpi_top_subject_predicate": over_top1(views.kpi_top_subject_predicate),
    "kpi_entity_issue_coverage": over_top1(views.kpi_entity_issue_coverage),
    "kpi_extraction_coverage_by_run": extraction_coverage,
    "top_entities": over_top1(views.top_entities, TOP_K),
    "top_issue_categories": over_top1(views.top_issue_categories, TOP_K),
    "top_subject_predicates": over_top1(views.top_subject_predicates, TOP_K),
    "top_issues_per_entity": over_top1(views.top_issues_per_entity, 3),
    "entity_issue_heatmap": over_top1(views.entity_issue_heatmap, tables.ISSUES),
    "daily_trend": over_top1(views.daily_trend),
    "run_drilldown": run_drilldown,
    "extraction_quality": extraction_quality,
    "entity_label_quality": entity_quality,
    "issue_label_quality": issue_quality,
}


def registered() -> dict[str, Query]:
    """All queries, in UTC and with comparable columns."""

    def wrap(query: Query) -> Query:
        def call(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return portable(query(spark, sf_dir))

        return call

    return {name: wrap(query) for name, query in QUERIES.items()}
