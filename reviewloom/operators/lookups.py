"""Joins against tables with one row per key: broadcast when small, and safe from hot keys when not."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 64 << 20
HOT_KEYS = 1_000
SPREAD = 1 << 20


def fits_broadcast(dim: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    """True when the values of a (landed) dictionary take at most ``max_bytes`` as text, keys included."""
    size = F.octet_length(F.to_json(F.struct(*dim.columns)))
    return (dim.agg(F.sum(size).alias("size")).first()["size"] or 0) <= max_bytes


def hot_key_left_join(
    facts: DataFrame, dim: DataFrame, on: list[str], weight: DataFrame, spread_by: Column,
    matchable: Column | None = None,
) -> DataFrame:
    """Left join to ``dim`` (one row per key) when a few keys may hold most of ``facts``.

    ``weight`` counts facts per key (column ``copies``). The ``HOT_KEYS`` heaviest keys are
    broadcast, with what ``dim`` has for them or nothing: a list of fixed length, after which no key
    holds more than 1/HOT_KEYS of the facts. The others meet in a shuffle join, in which facts
    already served, or that cannot match, are spread evenly instead of following their key: so
    ``facts`` is computed once, where two branches would compute it twice.
    """
    values = [c for c in dim.columns if c not in on]
    heaviest = weight.orderBy(F.desc("copies"), *on).limit(HOT_KEYS).select(*on)
    known = dim.join(F.broadcast(heaviest), on).select(*on, F.struct(*values).alias("_hot"))
    hot = heaviest.join(known, on, "left").withColumn("_served", F.lit(True))
    served = F.col("_served").isNotNull()
    for key in on:
        served = served | F.col(key).isNull()
    if matchable is not None:
        served = served | ~matchable
    away = F.pmod(F.xxhash64(spread_by), F.lit(SPREAD)).cast("int") + 1
    marked = facts.join(F.broadcast(hot), on, "left").withColumn("_part", F.when(served, away).otherwise(0))
    # always 0, but no literal: the optimiser would make the join key a condition, and spread nothing
    zero = F.pmod(F.xxhash64(*on), F.lit(1)).cast("int")
    rest = dim.select(*on, F.struct(*values).alias("_rest"), zero.alias("_part"))
    found = F.coalesce("_hot", "_rest")
    return (
        marked.join(rest, [*on, "_part"], "left")
        .select(*facts.columns, *[found[v].alias(v) for v in values])
    )


def lookup(
    facts: DataFrame,
    dim: DataFrame,
    on: list[str],
    spread_by: Column,
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Left join to a dictionary with one row per key, by broadcast or else safe from hot keys."""
    if fits_broadcast(dim, max_bytes):
        return facts.join(F.broadcast(dim), on, "left")
    weight = facts.groupBy(*on).agg(F.count("*").alias("copies"))
    return hot_key_left_join(facts, dim, on, weight, spread_by)


def first_per_key(rows: DataFrame, keys: list[str], value: str, order: list[str]) -> DataFrame:
    """The value of the first row per key in the given order; combines map-side."""
    return (
        rows.where(F.col(keys[0]).isNotNull())
        .groupBy(*keys)
        .agg(F.min_by(value, F.struct(*order)).alias(value))
    )


def last_per_key(rows: DataFrame, keys: list[str], value: str, order: list[str]) -> DataFrame:
    """The value of the last row per key in the given order; combines map-side."""
    return (
        rows.where(F.col(keys[0]).isNotNull())
        .groupBy(*keys)
        .agg(F.max_by(value, F.struct(*order)).alias(value))
    )
