"""Near copies by n-gram Jaccard: partitioned universe, pigeonhole signatures, exact verification."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_type
from pyspark.sql.window import Window

from reviewloom.llm.common import column, text_batches, text_of
from reviewloom.llm.components import merged
from reviewloom.session import land

BATCH_ROWS = 50_000
WORD_CACHE = 50_000
BROADCAST_ROWS = 2_000_000
#: One shingle of so many (by hash, over all documents) is counted for the cost estimate.
COUNTED = 256
#: Cost of a candidate against that of a signature row.
CANDIDATE = 4.0
BAND_RATIO = 1.4
#: Bits of the parity sketch of a set, and how many pivots a signature gets more from round to round.
SKETCH = 1024
#: The sketch folded to so many 64-bit words, which go with the members of a signature; wider ones follow
#: where the sets are too large for these.
FOLDED = 8
MORE_PIVOTS = 4
#: Up to how many rows all pairs of a signature are looked at: where neither folded sketches nor places
#: of differences keep nearly all pairs from being made, and where they do; more go by pivots.
SMALL, PLACED = 64, 1024
#: What names a set, and its pivot.
SET = ["id", "text_key"]
PIVOT = ["p_id", "p_key"]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def words_of(text: str) -> list[bytes]:
    """Runs without ASCII white space, A-Z lowered (bytes methods touch ASCII only)."""
    return text.encode().lower().split()


class Shingler:
    """Sorted distinct 64-bit shingle hashes of a text; remembers a bounded number of words."""

    def __init__(self, size: int) -> None:
        self.size, self.known = size, {}

    def __call__(self, text: str) -> np.ndarray:
        words = words_of(text)
        known = self.known
        if len(known) > WORD_CACHE:
            known.clear()
        for word in set(words).difference(known):
            known[word] = xxhash.xxh3_64_intdigest(word)
        h = np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))
        if not len(h):
            return h
        size = min(self.size, len(h))
        out = np.full(len(h) - size + 1, size, dtype=np.uint64)
        for i in range(size):
            out = _mixed(out * np.uint64(0x9E3779B97F4A7C15) + h[i : len(h) - size + 1 + i])
        return np.unique(out)


def shingle_set(text: str, size: int) -> set[bytes]:
    words = words_of(text)
    n = max(len(words) - size + 1, min(len(words), 1))
    return {b" ".join(words[i : i + size]) for i in range(n)}


@dataclass(frozen=True)
class Threshold:
    """Jaccard of at least num / den."""

    num: int
    den: int

    def smaller(self, n: int) -> int:
        """Least size of a partner of a set of n."""
        return -(-self.num * n // self.den)

    def apart(self, n: int) -> int:
        """Largest symmetric difference of a linked pair whose smaller set has at most n."""
        return (self.den - self.num) * (n + n * self.den // self.num) // (self.den + self.num)

    def close(self, differ: int, sizes: int) -> bool:
        """Whether sets of ``sizes`` elements together link, ``differ`` apart."""
        return (self.den + self.num) * differ <= (self.den - self.num) * sizes

    def sketch_bits(self, n: int) -> int:
        """Bits of the widest sketch of a set of n: ``SKETCH`` or a power of two beyond, such that a
        quarter is more than linked sets up to twice as large may differ in."""
        return max(SKETCH, 64 << (-(-self.bits_of()[0] * n // self.bits_of()[1]) - 1).bit_length())

    def bits_of(self) -> tuple[int, int]:
        """Numerator and denominator of the 64-bit words of a sketch per element of a set."""
        return self.den - self.num, 4 * (self.den + self.num)

    def radius(self, n: int) -> int:
        """Up to how many elements apart sets are near a pivot of n; any number gives whole results."""
        return n // 2 + self.apart(n)

    def prefix(self, differ: int, n: int, pivot: int, linked: bool) -> int:
        """How many of a set's ``differ`` differences from a pivot are signatures; see ``NearCopies``."""
        total, apart = self.den + self.num, self.den - self.num
        if linked:
            least = (total * differ + apart * (pivot - n)) // (2 * total) + 1
        else:
            least = -((apart * (n + pivot) - total * differ) // (2 * total))
        # what only one of two linked sets differs in from the pivot stands between them
        return differ - max(least, differ - self.apart(n), 1) + 1


@lru_cache(maxsize=None)
def band(i: int) -> tuple[int, int]:
    """Smallest and largest size of band i; bands grow by ``BAND_RATIO``."""
    low = 1 if i == 0 else band(i - 1)[1] + 1
    return low, max(low, int(low * BAND_RATIO) - 1)


def bands_of(n: int, threshold: Threshold) -> list[int]:
    """The band of size n, and lower ones that hold sizes of possible smaller partners."""
    own = 0
    while band(own)[1] < n:
        own += 1
    first = own
    while first and band(first - 1)[1] >= threshold.smaller(n):
        first -= 1
    return list(range(first, own + 1))


@dataclass(frozen=True)
class Allocation:
    """Segments kept ``whole``, segments with one-deletion neighbourhoods (``near``), and how many
    of the agreements a document may lose to empty signatures (``spare``)."""

    whole: int
    near: int
    spare: int


def allocate(n: float, least: int, apart: int, docs: float, share: float) -> Allocation:
    """The cheapest allocation for sets of about ``n`` (at least ``least``) elements.

    A whole segment is left differing by one element of difference, a neighbourhood segment by two.
    So with whole + 2 * near = apart + 1 + spare, a pair ``apart`` elements apart agrees on segments
    that weigh at least spare + 1 together. Empty segments agree with those of any stranger: a
    document whose agreements by an empty signature weigh at most ``spare`` need not give these
    signatures. Fewer, longer segments meet fewer strangers, but neighbourhoods cost a signature per
    element. ``share``: how likely another document holds a given shingle.
    """
    best = None
    for near in range((apart + 1) // 2 + 1):
        whole = apart + 1 - 2 * near
        low = math.exp(-least / (whole + near))
        lost = whole * low + 2 * near * low * (1 + least / (whole + near))
        spare = math.ceil(lost + 4 * math.sqrt(lost))
        whole += spare
        s = n / (whole + near)
        met = math.exp(-2 * s * (1 - share)) * (1 - math.exp(-s * share))
        cost = whole + near * (1 + s) + CANDIDATE * docs * met * (whole + near * (1 + 2 * s))
        if best is None or cost < best[0]:
            best = (cost, Allocation(whole, near, spare))
    return best[1]


def _set_rows(id_type: pa.DataType, size: int, threshold: Threshold):
    """Digest, size and parity sketch of each row's set; sets too large for the sketch have a ``wide``
    one, which gives the other when folded."""
    schema = pa.schema(
        [("id", id_type), ("text_key", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64()),
         ("n", pa.int32()), ("counted", pa.list_(pa.int64())), ("sketch", pa.list_(pa.int64())),
         ("wide", pa.list_(pa.int64()))]
    )

    def parities(h: np.ndarray, bits: int) -> np.ndarray:
        odd = np.bincount((h % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
        return np.packbits(odd.astype(bool)).view("<i8")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingler(size)
        for batch in batches:
            halves, sizes, counted, sketches, wide = [], [], [], [], []
            for text in batch.column(2):
                h = shingles(text.as_py())
                halves.append(np.frombuffer(xxhash.xxh3_128_digest(h.tobytes()), dtype="<i8"))
                sizes.append(len(h))
                counted.append(h[h % np.uint64(COUNTED) == 0].view(np.int64))
                sketches.append(parities(h, SKETCH))
                bits = threshold.sketch_bits(len(h))
                wide.append(parities(h, bits) if bits > SKETCH else None)
            both = np.array(halves, dtype=np.int64).reshape(len(sizes), 2)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(both[:, 0]), pa.array(both[:, 1]),
                 pa.array(sizes, pa.int32()), pa.array(counted, pa.list_(pa.int64())),
                 pa.array(sketches, pa.list_(pa.int64())), pa.array(wide, pa.list_(pa.int64()))],
                schema=schema,
            )

    return run, schema


def _signature_rows(
    id_type: pa.DataType,
    size: int,
    threshold: Threshold,
    plan: dict[int, Allocation],
    keyed: bool = False,
):
    """Signatures of ids and texts; ``keyed`` if the texts' keys follow and are to be kept."""
    schema = pa.schema(
        [("sig", pa.int64()), ("id", id_type), ("n", pa.int32()), ("full", pa.bool_())]
        + [("text_key", pa.int64())] * keyed
    )

    def signatures(h: np.ndarray) -> Iterator[tuple[np.ndarray, bool]]:
        for b in bands_of(len(h), threshold):
            if b not in plan:
                continue
            near, m = plan[b].near, plan[b].whole + plan[b].near
            salt = np.uint64((b + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
            element = _mixed(h ^ salt)
            segment = (_mixed(h + salt) % np.uint64(m)).astype(np.int64)
            sums = np.zeros(m, dtype=np.uint64)
            np.add.at(sums, segment, element)
            tag = _mixed(salt + np.arange(m, dtype=np.uint64))
            held = np.bincount(segment, minlength=m)
            lost = np.count_nonzero(held[near:] == 0) + 2 * np.count_nonzero(held[:near] <= 1)
            empty = 0 if lost > plan[b].spare else 1  # from how many elements on signatures are given
            kept = held >= empty
            yield _mixed(sums + tag)[kept], True
            if near:
                cut = (segment < near) & (held[segment] > empty)
                at = segment[cut]
                yield _mixed(sums[at] - element[cut] + tag[at]), False

    def rows(batch, sigs, at, n, full):
        where = pa.array(np.concatenate(at))
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(sigs).view(np.int64)), batch.column(0).take(where),
             pa.array(np.concatenate(n)), pa.array(np.concatenate(full)),
             *[key.take(where) for key in batch.columns[2:]]],
            schema=schema,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingler(size)
        for batch in batches:
            parts, held = ([], [], [], []), 0
            for i, text in enumerate(batch.column(1)):
                h = shingles(text.as_py())
                for sig, full in signatures(h) if len(h) else ():
                    k = len(sig)
                    for part, value in zip(
                        parts,
                        (sig, np.full(k, i), np.full(k, len(h), dtype=np.int32), np.full(k, full)),
                    ):
                        part.append(value)
                    held += k
                if held >= BATCH_ROWS:
                    yield rows(batch, *parts)
                    parts, held = ([], [], [], []), 0
            if held:
                yield rows(batch, *parts)

    return run, schema


def _compared(id_type: pa.DataType, size: int, threshold: Threshold):
    """Of pairs of a pivot and a member with their texts: the linked and the near ones, the latter with
    their differences, how many of these are signatures, and whether the member leaves (``strict``)."""
    schema = pa.schema(
        [("p_id", id_type), ("p_key", pa.int64()), ("id", id_type), ("text_key", pa.int64()),
         ("n", pa.int32()), ("linked", pa.bool_()), ("strict", pa.bool_()),
         ("prefix", pa.int32()), ("differ", pa.list_(pa.int64()))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingler(size)
        last_text, pivot, pivot_set = None, None, None
        for batch in batches:
            at, rows = [], ([], [], [], [], [])
            for i in range(batch.num_rows):
                text, other = batch.column(4)[i].as_py(), batch.column(5)[i].as_py()
                if text != last_text:
                    last_text, pivot, pivot_set = text, shingles(text), None
                h = shingles(other)
                differ = np.setxor1d(h, pivot, assume_unique=True)
                linked = threshold.close(len(differ), len(h) + len(pivot))
                if linked:
                    pivot_set = pivot_set or shingle_set(text, size)
                    other_set = shingle_set(other, size)
                    linked = threshold.close(
                        len(pivot_set ^ other_set), len(pivot_set) + len(other_set)
                    )
                room = threshold.radius(len(pivot)) - len(differ)
                if room < 0 and not linked:
                    continue
                at.append(i)
                prefix = threshold.prefix(len(differ), len(h), len(pivot), linked)
                found = differ.view(np.int64) if room >= 0 else None
                strict = room >= threshold.apart(len(h))
                for column_, value in zip(rows, (len(h), linked, strict, prefix, found)):
                    column_.append(value)
            if at:
                keys = [batch.column(c).take(pa.array(at, pa.int64())) for c in range(4)]
                found = [pa.array(v, schema.field(4 + i).type) for i, v in enumerate(rows)]
                yield pa.RecordBatch.from_arrays(keys + found, schema=schema)

    return run, schema


def _band_plan(sets: DataFrame, threshold: Threshold) -> dict[int, Allocation]:
    """Allocation per band from counts over all documents; moves a row per band to the driver,
    and the number of bands is the logarithm of the longest text."""

    bands = F.udf(lambda n: bands_of(n, threshold), "array<int>")

    sizes = sets.where("n > 0").groupBy("n").agg(F.count("*").alias("docs"))
    per_band = sizes.select(F.explode(bands("n")).alias("band"), "n", "docs")
    totals = per_band.groupBy("band").agg(
        F.sum("docs").alias("docs"), (F.sum(F.col("n") * F.col("docs")) / F.sum("docs")).alias("n")
    )
    seen = sets.select(F.explode("counted").alias("h")).groupBy("h").agg(F.count("*").alias("c"))
    all_docs = sets.where("n > 0").count()
    pairs = seen.agg(
        F.sum((F.col("c") * (F.col("c") - 1)).cast("double")).alias("pairs"), F.sum("c").alias("c")
    ).first()
    share = pairs.pairs / (pairs.c * all_docs) if pairs.c else 0.0
    plan = {}
    for row in totals.collect():
        low, high = band(row.band)
        apart = threshold.apart(high)
        if apart:
            plan[row.band] = allocate(row.n, low, apart, row.docs, min(share, 0.9))
    return plan


def _several(members: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Members with their ``component``, of signatures that hold more than one.

    Signatures of one ``origin`` with the same members (by count and 128 bits of their names) give the
    same pairs: near copies agree on most segments, so that one of them stays, the first in the order
    of places. Others' members differ, and theirs stay.
    """
    if labels is not None:
        members = members.join(labels, "id", "left")
        members = members.withColumn("component", F.coalesce("component", "id"))
    else:
        members = members.withColumn("component", F.col("id"))
    held = members.groupBy("sig").agg(
        F.min("component").alias("low"),
        F.max("component").alias("high"),
        F.min("origin").alias("origin"),
        F.min("place").alias("first"),
        F.count("*").alias("held"),
        F.bit_xor(F.xxhash64(*SET)).alias("names"),
        F.bit_xor(F.xxhash64(F.lit(1), *SET)).alias("others"),
    )
    alike = held.where("low <> high").groupBy("origin", "held", "names", "others")
    kept = alike.agg(F.min(F.struct("first", "sig")).alias("kept")).select("kept.sig")
    return members.join(kept, "sig", "left_semi")


def _fold(i: int) -> Column:
    """Word i of the parity sketch of ``FOLDED`` words: places that are equal modulo it are added."""
    words = [F.get("sketch", F.lit(w)) for w in range(i, SKETCH // 64, FOLDED)]
    return reduce(Column.bitwiseXOR, words)


def _fold_to(sketch: Column, size: Column) -> Column:
    """A parity sketch folded to ``size`` words; both sizes are powers of two."""
    def word(i: Column) -> Column:
        places = F.sequence(i, F.size(sketch) - 1, size)
        return F.aggregate(places, F.lit(0).cast("long"), lambda x, at: x.bitwiseXOR(F.get(sketch, at)))

    folded = F.transform(F.sequence(F.lit(0), size - 1), word)
    return F.when(F.size(sketch) == size, sketch).otherwise(folded)


class NearCopies:
    """Links between documents whose sets of word shingles have a Jaccard of num / den or more.

    A set holds the distinct runs of ``size`` words; a shorter text is one shingle, a text without
    words has none and is linked with nothing. Null texts count as empty. Ids name documents: rows
    with one id are one document with several sets; null ids are linked with nothing.

    1. Equal sets (128-bit digest) are found by grouping; one of them goes on.
    2. The others are hashed into segments by size band. Linked sets that are at most h elements
       apart agree on one of the signatures that ``allocate`` chose for their band.
    3. Rows of a signature that at least two documents hold are compared with a pivot, the least id:
       links found make components, and a signature whose other rows are of one component is
       finished. From the second round on, all members of a signature of at most ``SMALL``
       (``PLACED``) rows are pivots, which finishes it. In larger ones, rows near the pivot go on by
       other signatures (4), and the rest draws more pivots, 4, 16, ... at a time, members of the
       smallest components first.
    4. Sets x, y that link across components cannot both link with pivot b, so their differences
       X, Y from b have common elements. With c = (den - num) / (den + num), sets link when they are
       at most c times their sizes apart, so |X & Y| >= (|X| + |Y| - c(x + y)) / 2. If x does not
       link with b this is at least (|X| - c(x + b)) / 2, and if only x does, above
       (|X| + c(b - x)) / 2. So x needs as signatures only the rarest elements of X, as many as X
       has beyond that (a prefix filter), and sets that share one as their first need enough
       differences after it. Variants of one template, each with words of its own,
       so meet one pivot and hardly each other. Linked sets are either both near b or both beyond
       its radius less ``apart``; between the two a set goes both ways. A set leaves its signature
       at the first pivot that it is nearer to than that.
    5. Pairs are first compared by parity sketches, which no linked or near pair fails, and then
       exactly, on the words of both texts.
    """

    def __init__(
        self,
        docs: DataFrame,
        size: int = 5,
        num: int = 80,
        den: int = 100,
        id_col: str = "doc_id",
        text_col: str = "text",
    ) -> None:
        self.size, self.threshold = size, Threshold(num, den)
        self.spark: SparkSession = docs.sparkSession
        self.rows = docs.select(
            column(docs, id_col).alias("id"),
            F.xxhash64(text_of(docs, text_col)).alias("text_key"),
            text_of(docs, text_col).alias("text"),
        )
        self.id_type = to_arrow_type(self.rows.schema["id"].dataType)
        run, schema = _set_rows(self.id_type, size, self.threshold)
        with text_batches(self.spark):
            self.sets = land(self.rows.mapInArrow(run, from_arrow_schema(schema)), "sets")

    def equal_sets(self) -> DataFrame:
        """``id``, ``text_key``, ``rep``: rows whose set a smaller id holds as well."""
        full = self.sets.where("n > 0 and id is not null")
        classes = full.groupBy("h1", "h2", "n").agg(
            F.min("id").alias("rep"), F.max("id").alias("most")
        )
        classes = classes.where("rep <> most").drop("most")
        return full.join(classes, ["h1", "h2", "n"]).where("id <> rep").select("id", "text_key", "rep")

    def live_signatures(self, copies: DataFrame) -> DataFrame:
        """``sig``, ``id``, ``text_key``, ``n`` of signatures that several documents hold, at least
        one as a whole segment."""
        skip = copies.select(F.col("id").alias("c_id"), F.col("text_key").alias("c_key"))
        if copies.count() <= BROADCAST_ROWS:
            skip = F.broadcast(skip)
        on = (F.col("id") == F.col("c_id")) & (F.col("text_key") == F.col("c_key"))
        own = self.rows.where("id is not null").join(skip, on, "left_anti").select("id", "text", "text_key")
        plan = _band_plan(self.sets, self.threshold)
        run, schema = _signature_rows(self.id_type, self.size, self.threshold, plan, keyed=True)
        rows = own.mapInArrow(run, from_arrow_schema(schema))
        # a window, as an aggregation and a join would compute and shuffle the signatures twice; one
        # signature has at most a row for each document of its size band
        held = Window.partitionBy("sig")
        rows = (
            rows.withColumn("low", F.min("id").over(held))
            .withColumn("high", F.max("id").over(held))
            .withColumn("any_full", F.max("full").over(held))
        )
        return rows.where("low <> high and any_full").select("sig", *SET, "n").distinct()

    def labels(self) -> DataFrame:
        """``id``, ``component`` of the ids that any links connect to another."""
        copies = land(self.equal_sets(), "copies")
        with text_batches(self.spark):
            members = land(self.live_signatures(copies), "signatures")
        unplaced = F.lit(None).cast("int")
        members = members.select(
            "*", unplaced.alias("apart"), unplaced.alias("place"), F.lit(None).cast("long").alias("origin")
        )
        members = land(_several(members, None), "members")
        ids = members.select(F.col("id").alias("live_id")).distinct().hint("shuffle_hash")
        live = F.col("id") == F.col("live_id")
        texts = land(self.rows.join(ids, live, "left_semi").select(*SET, "text").distinct(), "texts")
        sketches = self.sets.join(ids, live, "left_semi").select(*SET, "n", "sketch", "wide").distinct()
        sketches = land(sketches, "sketches")
        folded = sketches.select(
            *SET, *[_fold(i).alias(f"fold_{i}") for i in range(FOLDED)], F.coalesce("wide", "sketch").alias("wide")
        )
        labels, pivots = None, 1
        while not members.isEmpty():
            ranked = self._ranked(members, pivots).join(folded, SET)
            wide = F.when(F.col("words") > FOLDED, _fold_to(F.col("wide"), F.col("words")))
            ranked = land(ranked.withColumn("wide", wide), "ranked")
            pairs = land(self._candidates(ranked, sketches), "pairs")
            with text_batches(self.spark, 200):
                near = land(self._verify(pairs, texts), "near")
            linked = near.where("linked and p_id <> id").select(
                F.least("p_id", "id").alias("a"), F.greatest("p_id", "id").alias("b")
            )
            if not linked.isEmpty():
                labels = merged(labels, linked.distinct())
            members = self._unfinished(ranked, near, labels, pivots)
            pivots *= MORE_PIVOTS
        equal = copies.select(F.col("rep").alias("a"), F.col("id").alias("b")).distinct()
        return merged(labels, equal)

    def _told(self, words: Column | int) -> Column:
        """Whether sketches of so many words tell strangers of a signature apart: a quarter of their bits,
        half of what random ones differ in, is more than its linked sets may differ in."""
        widest = F.max("n").over(Window.partitionBy("sig"))
        den, num = self.threshold.den, self.threshold.num
        return 2 * (den - num) * widest <= (den + num) * words * 16

    def _words(self) -> Column:
        """How many words of their sketches the members of a signature carry: ``FOLDED``, or as many as
        the widest sketch of its smallest set has (``Threshold.sketch_bits``)."""
        least = F.min("n").over(Window.partitionBy("sig")).cast("long")
        up, down = self.threshold.bits_of()
        parts = F.floor((least * up + down - 1) / down)  # exact: far below 2 ** 53
        widest = F.pow(F.lit(2), F.length(F.bin(parts - 1))).cast("int")
        widest = F.greatest(F.when(parts > 1, widest).otherwise(F.lit(1)), F.lit(SKETCH // 64))
        return F.when(self._told(FOLDED), F.lit(FOLDED)).otherwise(widest)

    def _bound(self) -> Column:
        """``SMALL`` or ``PLACED``, where places or sketches tell nearly all strangers apart."""
        told = self._told(self._words())
        return F.when(F.col("place").isNotNull() | told, PLACED).otherwise(SMALL)

    def _ranked(self, members: DataFrame, pivots: int) -> DataFrame:
        """Members of a signature by the size of their component there, smallest first, and how many
        are its ``pivots``: all of them where it is small, but in the first round."""
        share = F.count("*").over(Window.partitionBy("sig", "component"))
        held = F.count("*").over(Window.partitionBy("sig"))
        first = Window.partitionBy("sig").orderBy("share", *SET)
        ranked = members.withColumn("share", share).withColumn("rank", F.row_number().over(first))
        few = held <= (self._bound() if pivots > 1 else pivots + 1)
        return ranked.select(
            "*",
            F.when(few, held).otherwise(F.lit(pivots).cast("long")).alias("pivots"),
            few.alias("ends"),
            self._words().alias("words"),
        )

    def _most(self) -> Column:
        """How many elements apart a member ``n`` and a pivot ``p_n`` are at most that link or, unless
        the signature ``ends``, are near."""
        den, num = self.threshold.den, self.threshold.num
        links = F.floor((den - num) * (F.col("n") + F.col("p_n")) / (den + num))
        near = F.col("p_n") / 2 + F.floor((den - num) * (F.col("p_n") * (1 + den / num)) / (den + num)) + 1
        return F.when(F.col("ends"), links).otherwise(F.greatest(links, near))

    def _met(self, ranked: DataFrame, members: DataFrame, folded: bool = False) -> DataFrame:
        """``sig``, ``p_rank`` and both names of pivots and the members after them.

        Where all members are pivots, only those that may link: of different components, of fitting
        sizes, and with enough differences left, from the shared one on, for the overlap needed.
        ``folded``: only those whose folded sketches are not too far apart either.
        """
        den, num = self.threshold.den, self.threshold.num
        names = ["n", "component", "apart", "place"] + [*[f"fold_{i}" for i in range(FOLDED)], "wide"] * folded
        p = ranked.where(F.col("rank") <= F.col("pivots")).select(
            "sig",
            "ends",
            *[F.col(c).alias(p) for c, p in zip(SET, PIVOT)],
            F.col("rank").alias("p_rank"),
            *[F.col(c).alias(f"p_{c}") for c in names],
        )
        left = 1 + F.least(F.col("apart") - F.col("place"), F.col("p_apart") - F.col("p_place"))
        total = (den + num) * (F.col("apart") + F.col("p_apart"))
        overlaps = 2 * (den + num) * left >= total - (den - num) * (F.col("n") + F.col("p_n"))
        may_link = (
            (F.col("component") != F.col("p_component"))
            & (F.least("n", "p_n") * den >= F.greatest("n", "p_n") * num)
            & (F.col("apart").isNull() | overlaps)
        )
        own = members.select("sig", *SET, "rank", *names)
        met = own.join(p, "sig").where((F.col("rank") > F.col("p_rank")) & (~F.col("ends") | may_link))
        if folded:
            differ = [F.bit_count(F.col(f"fold_{i}").bitwiseXOR(F.col(f"p_fold_{i}"))) for i in range(FOLDED)]
            in_wide = F.zip_with("wide", "p_wide", lambda a, b: F.bit_count(a.bitwiseXOR(b)))
            in_wide = F.aggregate(in_wide, F.lit(0), lambda x, more: x + more)
            most = self._most()
            met = met.where((sum(differ) <= most) & F.when(F.col("wide").isNull(), True).otherwise(in_wide <= most))
        return met.select("sig", "p_rank", *PIVOT, *SET, "ends")

    def _candidates(self, ranked: DataFrame, sketches: DataFrame) -> DataFrame:
        """Distinct pairs of a pivot and a member that may link or, if that is of use, be near.

        Parity sketches (bits set where an odd number of elements falls) never differ in more bits
        than the sets do in elements. Folded to a quarter they go along with the members, and wider
        ones with members too large for these, so that most pairs end where they meet; ones of
        ``SKETCH`` bits are looked up for the others.
        """
        met = self._met(ranked, ranked, folded=True)
        pairs = met.groupBy(*PIVOT, *SET).agg(F.min("ends").alias("ends"))
        own = sketches.select(*SET, "n", "sketch")
        other = sketches.select(
            *[F.col(c).alias(p) for c, p in zip(SET, PIVOT)],
            F.col("n").alias("p_n"),
            F.col("sketch").alias("p_sketch"),
        )
        pairs = pairs.join(own, SET).join(other, PIVOT)
        differ = sum(
            F.bit_count(F.get("sketch", F.lit(i)).bitwiseXOR(F.get("p_sketch", F.lit(i))))
            for i in range(SKETCH // 64)
        )
        return pairs.where(differ <= self._most()).select(*PIVOT, *SET)

    def _verify(self, pairs: DataFrame, texts: DataFrame) -> DataFrame:
        pivot = texts.select(
            *[F.col(c).alias(p) for c, p in zip(SET, PIVOT)], F.col("text").alias("p_text")
        )
        both = pairs.join(texts, SET).join(pivot, PIVOT).select(*PIVOT, *SET, "p_text", "text")
        run, schema = _compared(self.id_type, self.size, self.threshold)
        return both.mapInArrow(run, from_arrow_schema(schema))

    def _unfinished(
        self, ranked: DataFrame, near: DataFrame, labels: DataFrame | None, pivots: int
    ) -> DataFrame:
        """Members of signatures, old and new, that still hold several components.

        ``origin`` names the round and the pivot of new ones: places are comparable within these only.
        """
        kept = ["sig", *SET, "n", "apart", "place", "origin"]
        rest = ranked.where(F.col("rank") > F.col("pivots")).select(*kept, "rank")
        many = F.count("*").over(Window.partitionBy("sig")) > self._bound()
        rest = land(_several(rest, labels).withColumn("many", many), "rest")
        large = rest.where("many")
        if large.isEmpty():
            return rest.select(*kept, "component")
        met = self._met(ranked, large).join(
            near.where("differ is not null").select(*PIVOT, *SET, "strict"), [*PIVOT, *SET]
        )
        met = land(met, "met")
        left = met.where("strict").groupBy("sig", *SET).agg(F.min("p_rank").alias("stop"))
        far = rest.join(left, ["sig", *SET], "left_anti").select(*kept)
        going = met.join(left, ["sig", *SET], "left").where("stop is null or p_rank <= stop")
        pairs = going.select(*PIVOT, *SET).distinct()
        elements = near.where("prefix > 0").join(pairs, [*PIVOT, *SET], "left_semi")
        apart = F.size("differ").alias("apart")
        elements = elements.select(*PIVOT, *SET, "n", "prefix", apart, F.explode("differ").alias("element"))
        origin = F.xxhash64(F.lit(pivots), *PIVOT)
        elements = elements.withColumn("origin", origin).withColumn("sig", F.xxhash64("origin", "element"))
        held = elements.groupBy("sig").agg(F.count("*").alias("held")).where("held > 1")
        rarest = Window.partitionBy(*PIVOT, *SET).orderBy(F.col("held").asc_nulls_first(), "sig")
        new = elements.join(held, "sig", "left").withColumn("place", F.row_number().over(rarest))
        new = new.where("place <= prefix and held is not null").select(*kept)
        return land(_several(land(far.unionByName(new), "both"), labels), "members")

    def per_document(self) -> DataFrame:
        """``id``, ``text_key``, ``n_shingles``, ``component_id`` (smallest id reached), per row."""
        labels = self.labels().select(F.col("id").alias("l_id"), "component")
        rows = self.sets.join(labels, F.col("id") == F.col("l_id"), "left")
        return rows.select(
            "id",
            "text_key",
            F.col("n").cast("long").alias("n_shingles"),
            F.coalesce("component", "id").alias("component_id"),
        )


def near_components(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """Per row: id, ``n_shingles``, ``component_id``; see ``NearCopies``."""
    found = NearCopies(docs, id_col=id_col, **options).per_document()
    return found.select(F.col("id").alias(id_col), "n_shingles", "component_id")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """``docs`` without the documents that reach a smaller id by links; all columns stay.

    Rows repeated with the id that stays all stay; empty texts and null ids stay.
    """
    found = NearCopies(docs, id_col=id_col, **options).per_document()
    gone = found.where("id <> component_id").select(F.col("id").alias("__gone")).distinct()
    return docs.join(gone, column(docs, id_col) == gone["__gone"], "left_anti")
