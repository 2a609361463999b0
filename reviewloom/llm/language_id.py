"""Language identification by Bayesian fusion of text, declared language, address suffix and host."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from reviewloom.llm.common import column, text_batches, text_of
from reviewloom.session import land

BUCKETS = 1 << 15
#: A text counts as at most so many independent letter triples: neighbouring triples overlap.
EVIDENCE = 40.0
UNKNOWN = "und"
CHUNK = 1 << 16
UNSEEN = 0.05  # counts of a bucket besides those of the sample


def _letters(text: str) -> Iterator[np.ndarray]:
    """Code points of the lowered text in chunks, every run of other characters as one space."""
    for at in range(0, len(text), CHUNK):
        part = text[max(at - 2, 0) : at + CHUNK].lower()
        kept = " ".join("".join(c if c.isalpha() else " " for c in part).split())
        yield np.frombuffer(f" {kept} ".encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)


def triples(text: str) -> np.ndarray:
    """Bucket numbers of the letter triples that hold at least a letter."""
    out = []
    for c in _letters(text):
        if len(c) > 2:
            h = (c[:-2] * np.uint64(2_654_435_761) + c[1:-1]) * np.uint64(40_503) + c[2:]
            h = (h ^ (h >> np.uint64(17))) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)
            out.append((h % np.uint64(BUCKETS)).astype(np.int64))
    return np.concatenate(out) if out else np.zeros(0, dtype=np.int64)


@dataclass(frozen=True)
class TextModel:
    """``languages``, and for each (and last for ``und``, flat) log-probabilities per bucket.

    ``base`` is a language's log-probability of a bucket that its sample doesn't hold; ``holders`` and
    ``gains``, from ``starts`` of a bucket on, are the languages that hold it and what it gains there.
    So a language takes space by what its sample holds, however many languages there are.
    """

    languages: tuple[str, ...]
    base: np.ndarray
    starts: np.ndarray
    holders: np.ndarray
    gains: np.ndarray

    def evidence(self, text: str) -> list[float] | None:
        """Log-likelihoods per language, for a text of ``EVIDENCE`` triples at most; None without any."""
        found = triples(text)
        if not len(found):
            return None
        counts = np.bincount(found, minlength=BUCKETS)
        held = np.flatnonzero(counts)
        first = self.starts[held]
        n = self.starts[held + 1] - first
        ends = np.cumsum(n)
        at = np.arange(ends[-1]) + np.repeat(first - ends + n, n)
        gained = self.gains[at] * np.repeat(counts[held], n)
        sums = np.bincount(self.holders[at], weights=gained, minlength=len(self.base))
        return ((self.base + sums / len(found)) * min(len(found), EVIDENCE)).tolist()


def fit_text(rows: DataFrame, max_rows: int = 2_000) -> TextModel:
    """From ``text`` and ``declared``: at most ``max_rows`` different texts of each language declared.

    Those of least hash are taken; only hashes are ranked, and texts filtered by the largest taken.
    Triples are counted by a grouped aggregation; the driver receives the sums of the buckets that a
    language's sample holds, at most ``BUCKETS`` of each language.
    """
    declared = rows.where("declared is not null and declared <> ''")
    names = sorted(r.declared for r in declared.select("declared").distinct().collect())
    hashed = declared.withColumn("hash", F.xxhash64("text"))
    nth = F.row_number().over(Window.partitionBy("declared").orderBy("hash"))
    ranked = hashed.select("declared", "hash").distinct().withColumn("nth", nth)
    bounds = ranked.where(F.col("nth") <= max_rows).groupBy("declared").agg(F.max("hash").alias("most"))
    chosen = hashed.join(F.broadcast(bounds), "declared").where("hash <= most")
    sample = chosen.groupBy("declared", "hash").agg(F.first("text").alias("text"))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, texts in batch.groupby("declared")["text"]:
                counts = np.bincount(
                    np.concatenate([triples(t) for t in texts]), minlength=BUCKETS
                )
                held = np.flatnonzero(counts)
                yield pd.DataFrame({"declared": name, "bucket": held, "n": counts[held]})

    counted = sample.mapInPandas(count, "declared string, bucket int, n long")
    sums = counted.groupBy("declared", "bucket").agg(F.sum("n").alias("n")).toArrow().to_pandas()
    number = {name: i for i, name in enumerate(names)}
    holders = sums["declared"].map(number).to_numpy(dtype=np.int32)
    buckets, n = sums["bucket"].to_numpy(), sums["n"].to_numpy(dtype=np.float64)
    totals = np.bincount(holders, weights=n, minlength=len(names)) + UNSEEN * BUCKETS
    base = np.append(np.log(UNSEEN / totals), -math.log(BUCKETS))
    order = np.argsort(buckets, kind="stable")
    starts = np.concatenate([[0], np.cumsum(np.bincount(buckets, minlength=BUCKETS))])
    return TextModel(tuple(names), base, starts, holders[order], np.log1p(n / UNSEEN)[order])


def _bound(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of the value, which is computed once; used within lambdas, it would be for each element."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _total(array: Column) -> Column:
    return F.aggregate(array, F.lit(0.0), lambda a, x: a + x)


def _softmax(logs: Column) -> Column:
    def powers(held: Column) -> Column:
        return _bound(F.array_max(held), lambda top: F.transform(held, lambda x: F.exp(x - top)))

    def shares(held: Column) -> Column:
        return _bound(_total(held), lambda total: F.transform(held, lambda x: x / total))

    return _bound(_bound(logs, powers), shares)


def _plus(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x + y)


def _numbers(values) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def _sums(array: Column, n: int) -> Column:
    return F.array(*[F.sum(F.get(array, F.lit(i))) for i in range(n)])


def _smoothed(own: Column, parent: Column, strength: float) -> Column:
    """Counts and their parent's distribution as one distribution."""

    def mixed(total: Column) -> Column:
        return F.zip_with(own, parent, lambda c, p: (c + strength * p) / (total + strength))

    return _bound(_total(own), mixed)


def identify(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    declared: Column | None = None,
    host: Column | None = None,
    suffix: Column | None = None,
    confidence: float = 0.5,
    strength: float = 10.0,
    declared_weight: float = 0.9,
    **limits: int,
) -> DataFrame:
    """Per row: id, ``text_key``, ``language``, ``confidence``, ``rejected``.

    The log-posterior of a language adds four kinds of evidence:

    * text: letter triples under a model per language, and a flat model for none of them (``und``);
    * ``declared``: how often the language is declared so, counted over all rows by the text's best
      language, mixed with ``1 - declared_weight`` of no information; null says nothing;
    * ``suffix`` of the address and ``host``: soft counts by text and declaration, summed by grouped
      aggregations over all rows, the host's smoothed towards its suffix's and that towards all
      rows' (``strength`` rows' worth each); a row's own share is taken out of its host's prior.

    A row is rejected when no letters are in it, when ``und`` is likeliest, or when the best
    language's posterior is below ``confidence``. Null texts count as empty; a null host is a host
    of its own. Only per-language tables reach the driver; hosts are joined as a table.
    """
    rows = docs.select(
        column(docs, id_col).alias("id"),
        F.xxhash64(text_of(docs, text_col)).alias("text_key"),
        text_of(docs, text_col).alias("text"),
        F.lower((F.lit(None) if declared is None else declared).cast("string")).alias("declared"),
        F.coalesce((F.lit(None) if host is None else host).cast("string"), F.lit("")).alias("host"),
        F.coalesce((F.lit(None) if suffix is None else suffix).cast("string"), F.lit("")).alias("suffix"),
    )
    model = fit_text(rows.select("text", "declared"), **limits)
    names = [*model.languages, UNKNOWN]
    n = len(names)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def evidence(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([shared.value.evidence(t) for t in texts], dtype=object)

    with text_batches(docs.sparkSession):
        seen = land(rows.withColumn("text_logs", evidence("text")).drop("text"), "evidence")
    by_text = F.array_position("text_logs", F.array_max("text_logs")) - 1
    agreed = seen.where("text_logs is not null and declared is not null")
    agreed = agreed.groupBy(by_text.cast("int").alias("best"), "declared").count()
    claims = agreed.where("declared <> ''").collect()
    totals = [0] * n
    for r in claims:
        totals[r.best] += r["count"]

    def log_of(i: int, count: int) -> float:
        share = (count + 1 / n) / (totals[i] + 1)
        return math.log(declared_weight * share + (1 - declared_weight) / n)

    unclaimed = [log_of(i, 0) for i in range(n)]
    more: dict[str, dict[int, float]] = {name: {} for name in model.languages}
    for r in claims:
        more[r.declared][r.best] = log_of(r.best, r["count"]) - unclaimed[r.best]
    said_of = docs.sparkSession.createDataFrame(
        list(more.items()), "s_declared string, more map<int,double>"
    )
    seen = seen.join(F.broadcast(said_of), F.col("declared") == F.col("s_declared"), "left")
    plus = F.transform(
        _numbers(unclaimed), lambda x, i: x + F.coalesce(F.try_element_at("more", i), F.lit(0.0))
    )
    said = F.when(F.col("more").isNotNull(), plus)
    nothing = _numbers([0.0] * n)
    own = _plus(F.coalesce("text_logs", nothing), F.coalesce(said, nothing))
    seen = seen.withColumn("own_logs", own).drop("more", "s_declared")
    seen = seen.withColumn("share", _softmax(F.col("own_logs")))
    letters = seen.where("text_logs is not null")
    hosts = letters.groupBy("suffix", "host").agg(_sums(F.col("share"), n).alias("host_sums"))
    hosts = land(hosts, "hosts")
    suffixes = hosts.groupBy("suffix").agg(_sums(F.col("host_sums"), n).alias("suffix_sums"))
    whole = hosts.agg(_sums(F.col("host_sums"), n).alias("all")).first()["all"]
    whole = [v or 0.0 for v in whole]
    total = sum(whole) + strength
    everywhere = _numbers([(v + strength / n) / total for v in whole])
    priors = hosts.join(
        suffixes.select("suffix", _smoothed(F.col("suffix_sums"), everywhere, strength).alias("parent")),
        "suffix",
    ).select(F.col("suffix").alias("h_suffix"), F.col("host").alias("h_host"), "host_sums", "parent")
    priors = land(priors, "priors")
    placed = seen.join(
        priors, (F.col("suffix") == F.col("h_suffix")) & (F.col("host") == F.col("h_host")), "left"
    )
    others = F.zip_with("host_sums", "share", lambda a, b: F.greatest(a - b, F.lit(0.0)))
    prior = _smoothed(others, F.col("parent"), strength)
    logs = _plus(F.col("own_logs"), F.transform(prior, lambda p: F.log(F.greatest(p, F.lit(1e-12)))))
    fused = placed.withColumn("posterior", _softmax(F.coalesce(logs, F.col("own_logs"))))
    top = F.array_max("posterior")
    best = F.get(F.array(*[F.lit(x) for x in names]), (F.array_position("posterior", top) - 1).cast("int"))
    none = F.col("text_logs").isNull()
    out = fused.select(
        F.col("id").alias(id_col),
        "text_key",
        F.when(none, F.lit(UNKNOWN)).otherwise(best).alias("language"),
        F.when(none, F.lit(0.0)).otherwise(F.round(top, 6)).alias("confidence"),
    )
    return out.withColumn(
        "rejected", (F.col("language") == UNKNOWN) | (F.col("confidence") < confidence)
    )


def drop_rejected(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the rows that ``identify`` rejects; all columns stay."""
    found = identify(docs, id_col, text_col, **options).where("rejected")
    gone = found.select(column(found, id_col).alias("__id"), F.col("text_key").alias("__key")).distinct()
    on = column(docs, id_col).eqNullSafe(gone["__id"]) & (
        F.xxhash64(text_of(docs, text_col)) == gone["__key"]
    )
    return docs.join(gone, on, "left_anti")


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[a-zA-Z][\w+.-]*://(?:[^/@]*@)?([^/:?#]+)", 1))


def suffix_of(host: Column) -> Column:
    return F.substring_index(host, ".", -1)


def declared_in(html: Column) -> Column:
    """Primary language tag of the markup's ``lang`` attribute, null without one."""
    tag = F.regexp_extract(F.coalesce(html, F.lit("")), r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([a-zA-Z]{2,3})", 1)
    return F.when(tag != "", F.lower(tag))
