"""Sentences, words and dictionary tags of review texts.

A token relation has one row per token, keyed by ``row_id`` and ordered by ``(sentence, place)``.
Reviews are hashed by ``row_id`` before they are split, so everything below works on co-located
tokens without another shuffle. A group is one review, whatever its length.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewloom.functions.text import JAPANESE, TextProfile, normalise
from reviewloom.operators.lookups import lookup

WORDS = r"[\p{L}\p{N}]+"
REVIEW_KEYS = ["run_id", "row_id", "review_id"]
#: Text of a partition of reviews. Its tokens take some 50 times these bytes where they are sorted.
PARTITION_TEXT = 4 << 20

# Word classes kept as tokens.
KEPT_POS = ("名詞", "動詞", "形容詞", "形容動詞", "連体詞", "接頭詞", "助詞", "助動詞", "記号")


@dataclass(frozen=True)
class UnknownWord:
    """Tags of words missing from the POS dictionary; their lemma is the surface."""

    pos: str = "名詞"
    sub_pos: str = "一般"
    inflection: str = "*"


def partitions_for(reviews: DataFrame, text: str = "review_text") -> int:
    """How many partitions reviews go to: the session's number, but no more text each than
    ``PARTITION_TEXT``, so that a task's tokens stay in memory whatever the size of the input.

    Reads the texts once, so ``reviews`` should be landed.
    """
    spark = reviews.sparkSession
    wanted = int(spark.conf.get("spark.sql.shuffle.partitions"))
    size = reviews.agg(F.sum(F.octet_length(text))).first()[0] or 0
    return max(wanted, spark.sparkContext.defaultParallelism, math.ceil(size / PARTITION_TEXT))


def by_review(reviews: DataFrame) -> DataFrame:
    """Reviews hashed by ``row_id`` into a number of partitions that grows with their text.

    Tokens take many times the bytes of the text they come from, so partitions must not be merged
    by the size of the text: with a number given, adaptive execution leaves them alone.
    """
    return reviews.repartition(partitions_for(reviews), "row_id")


def sentences(reviews: DataFrame, profile: TextProfile = JAPANESE) -> DataFrame:
    """One row per non-empty sentence; numbers count delimiters, so empty sentences leave gaps."""
    parts = F.split(normalise(F.col("review_text"), profile), r"\|")
    return (
        by_review(reviews)
        .select(*REVIEW_KEYS, F.posexplode(parts).alias("sentence", "text"))
        .where("text != ''")
        .withColumn("sentence", F.col("sentence") + 1)
    )


def words(sentence_rows: DataFrame) -> DataFrame:
    """Words of space-delimited languages: runs of letters and digits."""
    found = F.regexp_extract_all("text", F.lit(WORDS), F.lit(0))
    return sentence_rows.select(*REVIEW_KEYS, "sentence", F.posexplode(found).alias("place", "surface"))


def morphemes(reviews: DataFrame, profile: TextProfile = JAPANESE) -> DataFrame:
    """Words and sentence delimiters of a review in reading order, for compound rules.

    The first one carries the text, which offsets are searched in.
    """
    found = F.regexp_extract_all(normalise(F.col("review_text"), profile), F.lit(rf"{WORDS}|\|"), F.lit(0))
    rows = by_review(reviews).select(*REVIEW_KEYS, "review_text", F.posexplode(found).alias("place", "surface"))
    return rows.withColumn("review_text", F.when(F.col("place") == 0, F.col("review_text")))


def tag_morphemes(word_rows: DataFrame, dictionary: DataFrame, unknown: UnknownWord = UnknownWord()) -> DataFrame:
    """POS, sub-POS, inflection and lemma per word from a dictionary keyed by surface."""
    tagged = lookup(word_rows, dictionary, ["surface"], F.col("row_id"))
    return tagged.select(
        *word_rows.columns,
        F.coalesce("pos", F.lit(unknown.pos)).alias("pos"),
        F.coalesce("sub_pos", F.lit(unknown.sub_pos)).alias("sub_pos"),
        F.coalesce("inflection", F.lit(unknown.inflection)).alias("inflection"),
        F.coalesce("lemma", "surface").alias("lemma"),
    )


def keep_content(tagged: DataFrame) -> DataFrame:
    """Drop other word classes, and number the rest 0.. over the review and over the sentence."""
    review = Window.partitionBy("row_id").orderBy("sentence", "place")
    sentence = Window.partitionBy("row_id", "sentence").orderBy("place")
    return (
        tagged.where(F.col("pos").isin(*KEPT_POS))
        .withColumn("index", F.row_number().over(review) - 1)
        .withColumn("index_in_sentence", F.row_number().over(sentence) - 1)
    )


def tag_polarity(tokens: DataFrame, sentiment_lexicon: DataFrame, wanted: Column | None = None) -> DataFrame:
    """Polarities of each token's lemma (NULL when it has none), narrowed to ``wanted`` labels."""
    if wanted is not None:
        kept = F.array_intersect("polarities", wanted)
        sentiment_lexicon = sentiment_lexicon.withColumn("polarities", kept).where(F.size("polarities") > 0)
    return _by_lemma(tokens, sentiment_lexicon, "polarities")


def tag_synonym(tokens: DataFrame, synonyms: DataFrame) -> DataFrame:
    """Synonym by lemma and POS; ``synonyms`` holds one row per pair."""
    return lookup(tokens, synonyms.select("lemma", "pos", "synonym"), ["lemma", "pos"], F.col("row_id"))


def tag_categories(tokens: DataFrame, entity_lexicon: DataFrame, issue_lexicon: DataFrame) -> DataFrame:
    """Entity and issue category of each token's lemma, before subjects and predicates are formed."""
    return _by_lemma(_by_lemma(tokens, entity_lexicon, "entity"), issue_lexicon, "issue_category")


def merge_lexicons(lexicons: dict[str, DataFrame], labels: tuple[str, ...]) -> DataFrame:
    """The three dictionaries as one, with a row per term, so that tokens are looked up once."""
    wanted = F.array(*[F.lit(x) for x in labels])
    kept = F.array_intersect("polarities", wanted)
    sentiment = lexicons["sentiment"].select("term", kept.alias("polarities")).where(F.size("polarities") > 0)
    parts = [sentiment, lexicons["entity"].select("term", "entity"), lexicons["issue"].select("term", "issue_category")]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part, allowMissingColumns=True)
    return rows.groupBy("term").agg(*[
        F.first(c, ignorenulls=True).alias(c) for c in ("polarities", "entity", "issue_category")
    ])


def tag_terms(tokens: DataFrame, merged_lexicon: DataFrame) -> DataFrame:
    """Polarities, entity and issue category of each token's lemma from a merged dictionary."""
    return lookup(tokens, merged_lexicon.withColumnRenamed("term", "lemma"), ["lemma"], F.col("row_id"))


def _by_lemma(tokens: DataFrame, lexicon: DataFrame, value: str) -> DataFrame:
    dim = lexicon.select(F.col("term").alias("lemma"), value)
    return lookup(tokens, dim, ["lemma"], F.col("row_id"))
