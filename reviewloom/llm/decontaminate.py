"""Benchmark decontamination as a prefix-filtered containment join of word windows."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reviewloom.llm.common import ascii_lower, column, text_of
from reviewloom.session import land

#: Fixed value: what separates words, with capitals not yet lowered.
BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
BROADCAST_BYTES = 64 << 20


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, BETWEEN_WORDS), "")


def _shingle(array: Column, at: Column, size: int) -> Column:
    """64-bit key of ``size`` words from ``at`` on, folded by ``lower``; only a filter, so that words
    which agree after lowering A-Z always agree here."""
    return F.xxhash64(*[F.lower(F.get(array, at + i)) for i in range(size)])


def item_windows(items: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """Distinct windows: ``words`` (array, A-Z lowered), ``n`` words, ``item_ids`` holding them.

    Items without words have no window; a null id reads 'null'.
    """
    key = F.coalesce(column(items, id_col).cast("string"), F.lit("null"))
    rows = items.select(key.alias("item"), words(ascii_lower(text_of(items, text_col))).alias("w"))
    rows = rows.where("size(w) > 0").select(
        "item",
        "w",
        F.explode(F.sequence(F.lit(0), F.greatest(F.size("w") - window, F.lit(0)))).alias("at"),
    )
    cut = rows.select("item", F.slice("w", F.col("at") + 1, window).alias("words"))
    return (
        cut.groupBy("words")
        .agg(F.collect_set("item").alias("item_ids"))
        .select("words", F.size("words").alias("n"), "item_ids")
    )


def _blocks(table: DataFrame, key: str, size: Column) -> list[DataFrame]:
    """The table in as many blocks as keep each below the broadcast bound, by measured bytes."""
    total = table.agg(F.sum(size).alias("bytes")).first()["bytes"] or 0
    n = math.ceil(total / BROADCAST_BYTES)
    return [table.where(F.pmod(F.xxhash64(key), F.lit(n)) == i) for i in range(n)]


def _exploded(docs: DataFrame, size: int) -> DataFrame:
    """A row per word with its array and shingle key; one row for a document without words.

    The array is only referred to, never copied per word: explode, join and filter are one
    generated loop. The outer form keeps Catalyst from inferring a filter that splits texts twice.
    """
    return docs.select(
        *[c for c in docs.columns if c != "w"],
        "w",
        F.posexplode_outer("w").alias("pos", "word"),
    ).withColumn("key", _shingle(F.col("w"), F.col("pos"), size))


def find_windows(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    window: int = 10,
) -> DataFrame:
    """Occurrences of item windows: ``id``, ``text_key``, ``n_words``, ``start``, ``n``, ``item_ids``.

    For containment of a whole window one token is a sufficient prefix, if tokens are ordered by
    rarity. So: count each shingle of the windows over all documents (all of the corpus, every
    round), keep each window's rarest shingle with its offset, and look up every document position
    in these. A hit fixes where the window would start; it must start at 0 or later and end within
    the document (positional and length bound), and then all its words are compared.
    Every document also gives a row with null ``start``. Shingles are two words, for windows of one
    word that word. Items larger than the broadcast bound are served in blocks.
    """
    text = text_of(docs, text_col)
    base = docs.select(
        column(docs, id_col).alias("id"),
        F.xxhash64(text).alias("text_key"),
        words(text).alias("w"),
    )
    windows = land(item_windows(items, item_id_col, item_text_col, window), "windows")
    found = []
    for size in (1, 2):
        fits = F.col("n") == 1 if size == 1 else F.col("n") > 1
        own = windows.where(fits).withColumn(
            "at", F.explode(F.sequence(F.lit(0), F.col("n") - size))
        )
        tokens = own.withColumn("key", _shingle(F.col("words"), F.col("at"), size))
        if tokens.isEmpty():
            continue
        counts = None
        for block in _blocks(tokens.select("key").distinct(), "key", F.lit(8)):
            part = (
                _exploded(base.select("w"), size)
                .join(F.broadcast(block), "key", "left_semi")
                .groupBy("key")
                .agg(F.count("*").alias("times"))
            )
            counts = part if counts is None else counts.unionByName(part)
        rarity = Window.partitionBy("words").orderBy("times", "key", "at")
        prefix = land(
            tokens.join(counts, "key", "left")
            .withColumn("rank", F.row_number().over(rarity))
            .where("rank = 1 and times > 0")
            .select("key", "at", "words", "n", "item_ids"),
            "prefixes",
        )
        bytes_of = F.octet_length(F.array_join("words", " ")) + F.octet_length(
            F.array_join("item_ids", ",")
        ) + 64
        found += [(size, block) for block in _blocks(prefix, "key", bytes_of)]
    empty = windows.limit(0).selectExpr("0L key", "0 at", "words", "n", "item_ids")
    hits = [_occurrences(base, size, block) for size, block in found or [(1, empty)]]
    out = hits[0]
    for more in hits[1:]:
        out = out.unionByName(more.where("start is not null"))
    return out


def _occurrences(base: DataFrame, size: int, prefix: DataFrame) -> DataFrame:
    probe = prefix.select(
        F.col("key").alias("p_key"),
        "at",
        F.array_join("words", " ").alias("p_words"),
        "n",
        "item_ids",
    )
    start = F.col("pos") - F.col("at")
    joined = _exploded(base, size).join(F.broadcast(probe), F.col("key") == F.col("p_key"), "left")
    inside = F.col("p_key").isNotNull() & (start >= 0) & (start + F.col("n") <= F.size("w"))
    equal = (
        ascii_lower(F.array_join(F.slice("w", F.greatest(start, F.lit(0)) + 1, F.col("n")), " "))
        == F.col("p_words")
    )
    hit = F.when(inside, equal).otherwise(F.lit(False))
    return (
        joined.select(
            "id",
            "text_key",
            F.size("w").alias("n_words"),
            "pos",
            start.alias("start"),
            "n",
            "item_ids",
            hit.alias("hit"),
        )
        .where("hit or coalesce(pos, 0) = 0")
        .select(
            "id",
            "text_key",
            "n_words",
            *[F.when(F.col("hit"), F.col(c)).alias(c) for c in ("start", "n", "item_ids")],
        )
    )


def contamination(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    window: int = 10,
) -> DataFrame:
    """Per document: id, ``n_words``, ``n_hit``, ``spans``, ``item_ids``.

    ``spans`` are the (start, end) word ranges of occurring windows, ``n_hit`` the words inside any
    of them, ``item_ids`` the items they belong to, sorted as strings. Null and empty texts have no
    words; rows that repeat both id and text count as one document, rows with one id and different
    texts as several. Without items nothing is hit. Other columns are not read.
    """
    found = find_windows(docs, items, id_col, text_col, item_id_col, item_text_col, window)
    span = F.when(
        F.col("start").isNotNull(),
        F.struct(F.col("start").alias("start"), (F.col("start") + F.col("n")).alias("end")),
    )
    per_doc = found.groupBy("id", "text_key").agg(
        F.max("n_words").cast("long").alias("n_words"),
        F.sort_array(F.collect_set(span)).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("item_ids")))).alias("item_ids"),
    )
    covered = F.aggregate(
        "spans",
        F.struct(F.lit(0).alias("hit"), F.lit(0).alias("reach")),
        lambda acc, s: F.struct(
            (
                acc["hit"]
                + F.greatest(s["end"] - F.greatest(s["start"], acc["reach"]), F.lit(0))
            ).alias("hit"),
            F.greatest(acc["reach"], s["end"]).alias("reach"),
        ),
    )["hit"]
    return per_doc.select(
        F.col("id").alias(id_col),
        "text_key",
        "n_words",
        covered.cast("long").alias("n_hit"),
        "spans",
        "item_ids",
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, **names: str) -> DataFrame:
    """The rows of ``docs`` in which no window of any item occurs, with all their columns.

    Repeated rows all stay or all go.
    """
    id_col, text_col = names.get("id_col", "doc_id"), names.get("text_col", "text")
    bad = contamination(docs, items, **names).where("n_hit > 0")
    bad = bad.select(column(bad, id_col).alias("__bad_id"), F.col("text_key").alias("__bad_text"))
    on = column(docs, id_col).eqNullSafe(bad["__bad_id"]) & (
        F.xxhash64(text_of(docs, text_col)) == bad["__bad_text"]
    )
    return docs.join(bad, on, "left_anti")
