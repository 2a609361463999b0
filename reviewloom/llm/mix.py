"""Mixing sources to target weights by fixed-length blocks and pseudorandom index permutations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reviewloom.llm.common import column, running_total, same, spaced_words, text_of
from reviewloom.session import land

WEIGHTS = (5, 2, 1)
SEED = 7


def source_targets(sizes: DataFrame, weights: tuple[int, ...], share: float, cap: float) -> DataFrame:
    """Per source: ``source``, ``no`` (rank by code point, null last), ``source_size``, ``target``.

    Sources share ``share`` times all words by weight; a target stops at ``cap`` times its source's
    size and the excess is shared again. Each round sums the sources once and moves two numbers to
    the driver; the level only rises, so the rounds end when no source is newly capped.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.get(F.array(*[F.lit(w) for w in weights]), F.pmod(F.col("no"), F.lit(len(weights))))
    sources = land(
        totals.withColumn("no", rank).withColumn("weight", weight.cast("long")), "sources"
    )
    limit = F.col("source_size") * F.lit(float(cap))
    whole = sources.agg(F.sum("source_size").alias("n"), F.sum("weight").alias("w")).first()
    wanted = share * (whole.n or 0)
    level, before = (wanted / whole.w if whole.w else 0.0), None
    while level != before:
        capped = limit < F.col("weight") * F.lit(level)
        left = sources.agg(
            F.sum(F.when(capped, limit).otherwise(0.0)).alias("n"),
            F.sum(F.when(capped, 0).otherwise(F.col("weight"))).alias("w"),
        ).first()
        before, level = level, (wanted - left.n) / left.w if left.w else level
    share_of = F.col("weight") * F.lit(level)
    return sources.select(
        "source", "no", "source_size", F.when(limit < share_of, limit).otherwise(share_of).alias("target")
    )


def source_blocks(targets: DataFrame, block_words: int, least_blocks: int) -> DataFrame:
    """Add ``length`` (words a block), ``n_blocks`` and ``quota`` (blocks the mix takes).

    The length is fixed within a source: ``block_words``, or less where the source would otherwise
    have fewer than ``least_blocks`` blocks, so that rounding to whole blocks stays small.
    """
    length = F.least(
        F.lit(block_words).cast("long"), F.ceil(F.col("source_size") / F.lit(least_blocks))
    )
    n_blocks = F.ceil(F.col("source_size") / F.col("length")).cast("long")
    quota = F.round(F.col("target") * F.col("n_blocks") / F.col("source_size")).cast("long")
    return (
        targets.where("source_size > 0")
        .withColumn("length", length.cast("long"))
        .withColumn("n_blocks", n_blocks)
        .withColumn("quota", quota)
    )


def shard_counts(blocks: DataFrame, shard_slots: int, seed: int) -> DataFrame:
    """``shard``, ``no``, ``count``: slots of each source in each output shard.

    Every slot of a shard draws a source with probability in proportion to its quota, so a shard's
    counts are multinomial. Draws beyond a source's quota (in shard order) are handed, one by one,
    to the sources that fell short, so that each source's counts add up to its quota exactly.
    A draw is a lookup of a random number below the sum of quotas among the unit rows that quotas
    unfold to: an equi-join without hot keys, for any number of sources.
    """
    spark = blocks.sparkSession
    n = blocks.agg(F.sum("quota").alias("n")).first().n or 0
    by_no = Window.orderBy("no").rowsBetween(Window.unboundedPreceding, -1)
    owners = (
        blocks.withColumn("first", F.coalesce(F.sum("quota").over(by_no), F.lit(0)))
        .where("quota > 0")
        .select(
            "no", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("quota") - 1)).alias("pick")
        )
    )
    slots = spark.range(n).select(
        F.floor(F.col("id") / shard_slots).alias("shard"),
        F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(n or 1)).alias("pick"),
    )
    drawn = slots.join(_large(owners), "pick").groupBy("shard", "no").agg(F.count("*").alias("drawn"))
    drawn = running_total(drawn, ["no"], ["shard"], "drawn", "before")
    drawn = drawn.join(blocks.select("no", "quota"), "no")
    taken = F.greatest(F.least(F.col("drawn"), F.col("quota") - F.col("before")), F.lit(0))
    drawn = land(drawn.select("shard", "no", "drawn", taken.alias("count")), "draws")
    surplus = drawn.groupBy("shard").agg(F.sum(F.col("drawn") - F.col("count")).alias("over"))
    surplus = _units(surplus.where("over > 0"), "shard", "over")
    short = (
        blocks.select("no", "quota")
        .join(drawn.groupBy("no").agg(F.sum("count").alias("got")), "no", "left")
        .select("no", (F.col("quota") - F.coalesce("got", F.lit(0))).alias("short"))
    )
    short = _units(short.where("short > 0"), "no", "short")
    moved = surplus.join(_large(short), "unit").groupBy("shard", "no").agg(F.count("*").alias("count"))
    both = drawn.select("shard", "no", "count").unionByName(moved)
    return both.groupBy("shard", "no").agg(F.sum("count").alias("count")).where("count > 0")


def _large(unfolded: DataFrame) -> DataFrame:
    """Join by sorting: unfolded rows are estimated at the size before, and would be broadcast."""
    return unfolded.hint("merge")


def _units(rows: DataFrame, key: str, value: str) -> DataFrame:
    """Unfold each row to ``value`` numbered unit rows; numbers go on from row to row."""
    numbered = running_total(rows.withColumn("__all", F.lit(0)), ["__all"], [key], value, "first")
    return numbered.select(
        key, F.explode(F.sequence(F.col("first"), F.col("first") + F.col(value) - 1)).alias("unit")
    )


def permuted(index: Column, n: Column, key: Column) -> Column:
    """A bijection of 0..n-1 for each key, at ``index``.

    Two rounds of odd multiplication and shifted exclusive-or are a bijection of the b-bit numbers,
    b the bits of n; results of n or more are mapped again until they fall below n (at least every
    second value does; 64 tries leave one in 2**64).
    """
    bits = F.greatest(F.length(F.bin(n - 1)), F.lit(2))
    mask = F.call_function("shiftleft", F.lit(1).cast("long"), bits) - 1
    half = F.ceil(bits / 2).cast("int")

    def odd(salt: int) -> Column:
        return F.xxhash64(key, F.lit(salt)).bitwiseAND(F.lit((1 << 20) - 1)).bitwiseOR(F.lit(1))

    def turn(x: Column) -> Column:
        for salt in (1, 2):
            x = (x * odd(salt) + odd(salt + 2)).bitwiseAND(mask)
            x = x.bitwiseXOR(F.call_function("shiftright", x, half))
        return x

    tries = F.sequence(F.lit(1), F.lit(64))
    return F.aggregate(tries, turn(index), lambda x, _: F.when(x < n, x).otherwise(turn(x)))


def mix_slots(blocks: DataFrame, counts: DataFrame, seed: int) -> DataFrame:
    """``shard``, ``slot``, ``no``, ``block``: a source's slots, counted through all shards, run over
    its blocks in a new permutation each time around."""
    ordered = running_total(counts, ["no"], ["shard"], "count", "first")
    ordered = ordered.join(blocks.select("no", "n_blocks"), "no")
    slots = ordered.select(
        "shard",
        "no",
        "n_blocks",
        F.explode(F.sequence(F.col("first"), F.col("first") + F.col("count") - 1)).alias("slot"),
    )
    around = F.floor(F.col("slot") / F.col("n_blocks"))
    keyed = slots.withColumn("key", F.xxhash64("no", around, F.lit(seed)))
    block = permuted(F.pmod("slot", "n_blocks"), F.col("n_blocks"), F.col("key"))
    return keyed.select("shard", "slot", "no", block.alias("block"))


class Mix:
    """A mix of ``docs``: ``targets`` per source, ``rows`` (documents with their place in their
    source's word stream) and ``spans`` (the words that each output slot takes).

    Words are maximal runs without ASCII white space; null texts have none; a null source is a
    source of its own, sorted last. A source's documents are laid end to end by id (null first) and
    cut into blocks. A source is taken at most ``cap`` times through, so no document exceeds
    ``cap`` times its size (for a whole ``cap``). All draws are hashes of positions: reruns agree.
    """

    def __init__(
        self,
        docs: DataFrame,
        id_col: str = "doc_id",
        text_col: str = "text",
        source_col: str = "source",
        weights: tuple[int, ...] = WEIGHTS,
        share: float = 1.5,
        cap: int = 2,
        block_words: int = 64,
        least_blocks: int = 256,
        shard_slots: int = 4096,
        seed: int = SEED,
    ) -> None:
        text = text_of(docs, text_col)
        sizes = land(
            docs.select(
                column(docs, id_col).alias("id"),
                column(docs, source_col).alias("source"),
                F.xxhash64(text).alias("text_key"),
                F.size(spaced_words(text)).cast("long").alias("size"),
            ),
            "sizes",
        )
        self.targets = land(source_targets(sizes, weights, share, cap), "targets")
        self.blocks = land(source_blocks(self.targets, block_words, least_blocks), "blocks")
        named = sizes.join(self.targets, same(sizes["source"], self.targets["source"])).drop(
            self.targets["source"]
        )
        self.rows = land(
            running_total(named, ["no"], ["id", "size", "text_key"], "size", "first_word"), "rows"
        )
        counts = land(shard_counts(self.blocks, shard_slots, seed), "counts")
        self.slots = mix_slots(self.blocks, counts, seed)

    @property
    def spans(self) -> DataFrame:
        """``shard``, ``no``, ``slot``, ``id``, ``text_key``, ``first_word`` (of the document's row in
        its source), ``start``, ``end``: words start..end-1 of the document fill part of the slot."""
        end = F.col("first_word") + F.col("size")
        length = F.col("length")
        placed = self.rows.where("size > 0").join(self.blocks.select("no", "length"), "no")
        held = placed.withColumn(
            "block",
            F.explode(
                F.sequence(F.floor(F.col("first_word") / length), F.floor((end - 1) / length))
            ),
        )
        start = F.greatest(F.col("first_word"), F.col("block") * length)
        stop = F.least(end, (F.col("block") + 1) * length)
        return held.join(_large(self.slots), ["no", "block"]).select(
            "shard",
            "no",
            "slot",
            "id",
            "text_key",
            "size",
            "first_word",
            (start - F.col("first_word")).alias("start"),
            (stop - F.col("first_word")).alias("end"),
        )

    def per_document(self) -> DataFrame:
        """``id``, ``source``, ``size``, ``source_size``, ``target``, ``taken``, one row per document."""
        key = ["no", "first_word", "id", "text_key", "size"]
        taken = self.spans.groupBy(*key).agg(F.sum(F.col("end") - F.col("start")).alias("taken"))
        taken = taken.select(*[F.col(c).alias(f"__{c}") for c in key], "taken")
        joined = self.rows.where("size > 0").join(
            taken, [same(F.col(c), F.col(f"__{c}")) for c in key], "left"
        )
        joined = joined.withColumn("taken", F.coalesce("taken", F.lit(0).cast("long")))
        none = self.rows.where("size = 0").withColumn("taken", F.lit(0).cast("long"))
        columns = ["id", "source", "size", "source_size", "target", "taken"]
        return joined.select(*columns).unionByName(none.select(*columns))


def mix(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """Per document: id, ``source``, ``size``, ``source_size``, ``target``, ``taken``; see ``Mix``.

    Empty tables and tables without any word give rows with 0 taken; other columns are not read.
    """
    return Mix(docs, id_col, **options).per_document().withColumnRenamed("id", id_col)
