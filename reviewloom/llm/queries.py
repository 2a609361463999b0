"""Registered queries of this subpackage and their DuckDB statements."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom.llm import (
    byte_bpe,
    decontaminate,
    divergence,
    exact_dedup,
    html_extract,
    jaccard_join,
    language_id,
    lexical_search,
    line_dedup,
    mix,
    token_counts,
    toxicity,
    warc,
)

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as model:
        return token_counts.token_counts(table(spark, sf_dir, "documents"), model.read())


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents: declared language ``lang``, host ``source``; they have no address."""
    found = language_id.identify(
        table(spark, sf_dir, "documents"), declared=F.col("lang"), host=F.col("source")
    )
    return found.drop("text_key")


def language_id_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages: language of the markup, host and suffix of the address, main text."""
    pages = table(spark, sf_dir, "pages")
    texts = html_extract.extract(pages).select("page_id", "url", "text")
    declared = pages.select(
        F.col("page_id").alias("id"), language_id.declared_in(F.col("html")).alias("declared")
    )
    rows = texts.join(declared, F.col("page_id") == F.col("id"), "left")
    host = language_id.host_of(F.col("url"))
    found = language_id.identify(
        rows, "page_id", declared=F.col("declared"), host=host, suffix=language_id.suffix_of(host)
    )
    return found.drop("text_key")


def op7_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    folder = warc.scratch_folder(spark)
    warc.write_warc(pages, folder, shard_bytes=32 << 20, roll_bytes=4 << 20)
    return warc.read_warc(spark, folder, pages.schema["page_id"].dataType).drop("url")


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return jaccard_join.near_components(docs, size=3, num=90, den=100)


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    marked = line_dedup.with_bitmaps(docs, line_dedup.line_keep_bitmaps(docs))
    text = F.coalesce("text", F.lit(""))
    n_lines = F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1
    return marked.select(
        "doc_id",
        n_lines.cast("long").alias("n_lines"),
        F.coalesce("__n_dropped", F.lit(0).cast("long")).alias("n_dropped"),
        F.sha2(line_dedup.kept_text(text, "__keep_bitmap"), 256).alias("kept_sha256"),
    )


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as file:
        ranks = file.read()
    encoded = byte_bpe.encode(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
    return byte_bpe.decode(encoded, ranks).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergences(table(spark, sf_dir, "documents"))


def registered() -> dict[str, Query]:
    return {
        "op1_exact_dedup": op1_exact_dedup,
        "op2_decontaminate": op2_decontaminate,
        "op3_toxicity": op3_toxicity,
        "op4_mix": op4_mix,
        "op5_token_counts": op5_token_counts,
        "op6_language_id": op6_language_id,
        "language_id_pages": language_id_pages,
        "op7_html_extract": op7_html_extract,
        "op8_warc": op8_warc,
        "op9_jaccard_join": op9_jaccard_join,
        "op10_line_dedup": op10_line_dedup,
        "op11_byte_bpe": op11_byte_bpe,
        "op12_lexical_search": op12_lexical_search,
        "op13_source_divergence": op13_source_divergence,
    }
