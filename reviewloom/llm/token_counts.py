"""Token counts of byte-pair models: merging over a heap and a linked list, without identifiers."""

from __future__ import annotations

import re
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewloom.llm.common import column, text_of

SPACE = "▁"
#: Distinct words whose counts a worker remembers (some 100 MB at most for usual words).
REMEMBERED = 1_000_000


class Merges:
    """Ranks of a byte-pair model: ``ranks`` of pieces (lower merges first, equal ranks leftmost
    first), and whether symbols outside the vocabulary count as their UTF-8 bytes."""

    def __init__(self, ranks: dict[str, float], byte_fallback: bool, dummy_prefix: bool) -> None:
        self.ranks, self.byte_fallback, self.dummy_prefix = ranks, byte_fallback, dummy_prefix
        joined = any(SPACE in piece.lstrip(SPACE) for piece in ranks)
        lines = any("\n" in piece for piece in ranks)
        # No merge crosses from another character to a space if no piece does, nor any line feed
        # that no piece holds: such parts are counted by themselves.
        if joined:
            self.parts = re.compile(r".+", re.S) if lines else re.compile(r"[^\n]+")
        else:
            ends = "" if lines else r"\n"
            self.parts = re.compile(f"{SPACE}+[^{SPACE}{ends}]*|[^{SPACE}{ends}]+")
        self.line_feed = 0 if lines else 1
        self.known: dict[str, int] = {}

    def count_part(self, part: str) -> int:
        """Initial symbols minus merges, plus the further bytes of symbols without a piece."""
        ranks = self.ranks
        symbols = list(part)
        n = len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [
            (ranks[pair], i, 2)
            for i in range(n - 1)
            if (pair := symbols[i] + symbols[i + 1]) in ranks
        ]
        heapify(heap)
        merges = 0
        while heap:
            _, i, size = heappop(heap)
            j = after[i]
            if not symbols[i] or j >= n or len(symbols[i]) + len(symbols[j]) != size:
                continue  # one of the two has merged since
            symbols[i] += symbols[j]
            symbols[j] = ""
            merges += 1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (pair := symbols[i] + symbols[k]) in ranks:
                    heappush(heap, (ranks[pair], i, len(pair)))
            h = before[i]
            if h >= 0 and (pair := symbols[h] + symbols[i]) in ranks:
                heappush(heap, (ranks[pair], h, len(pair)))
        if not self.byte_fallback:
            return n - merges
        return n - merges + sum(len(s.encode()) - 1 for s in symbols if s and s not in ranks)

    def count(self, text: str) -> int:
        if not text:
            return 0
        parts = self.parts.findall((" " * self.dummy_prefix + text).replace(" ", SPACE))
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
        for part in set(parts).difference(known):
            known[part] = self.count_part(part)
        return sum(map(known.__getitem__, parts)) + text.count("\n") * self.line_feed


def read_merges(model: bytes) -> Merges:
    """From a sentencepiece byte-pair model that does not normalise or collapse white space."""
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(model)
    normal, user_defined = 1, 4
    rules = proto.normalizer_spec
    if (
        proto.trainer_spec.model_type != 2
        or rules.precompiled_charsmap
        or rules.remove_extra_whitespaces
        or not rules.escape_whitespaces
        or any(p.type == user_defined for p in proto.pieces)
    ):
        raise ValueError("only byte-pair models without normalisation or user-defined pieces")
    ranks = {p.piece: -p.score for p in proto.pieces if p.type == normal}
    return Merges(ranks, proto.trainer_spec.byte_fallback, rules.add_dummy_prefix)


_MERGES: dict[int, Merges] = {}


def token_counts(
    docs: DataFrame,
    model: bytes,
    id_col: str = "doc_id",
    text_col: str = "text",
    limit: int = 4096,
) -> DataFrame:
    """Per row: id, ``n_bytes``, ``n_tokens``, ``over_limit``; ``model`` is the model file's content.

    Whole texts, null as empty (no tokens), without begin and end tokens; strings of special tokens
    inside texts are ordinary text. One pass without a shuffle; the model (some 500 kB) is broadcast.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(T.LongType())
    def counts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        key = hash(shared.value)
        if key not in _MERGES:
            _MERGES.clear()
            _MERGES[key] = read_merges(shared.value)
        count = _MERGES[key].count
        for texts in batches:
            yield pd.Series([count(t) for t in texts], dtype="int64")

    text = text_of(docs, text_col)
    rows = docs.select(
        column(docs, id_col).alias(id_col),
        F.octet_length(text).cast("long").alias("n_bytes"),
        counts(text).alias("n_tokens"),
    )
    return rows.withColumn("over_limit", F.col("n_tokens") > limit)
