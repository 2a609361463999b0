"""Byte-level byte-pair encoding by a global shuffle of distinct words, and decoding by the token table."""

from __future__ import annotations

import base64
import re
import sys
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_type

from reviewloom.llm.common import column, text_of

#: Characters of text at which a block of documents is full, and buckets of words per shuffle partition.
BLOCK_CHARS = 16 << 20
BUCKETS_PER_PARTITION = 4
#: Matches taken from a long text at a time, and what counts as long.
MATCHES, LONG_TEXT = 1_000_000, 16 << 20
#: Encoded words of a bucket that a task remembers, and positions that are put together at a time.
REMEMBERED = 500_000
ASSEMBLED = 100_000
#: Rows that are decoded at a time.
DECODED = 500
#: Up to this length a word's pairs are searched one by one, beyond it they are kept in a heap.
SHORT_WORD = 40


def read_ranks(lines: bytes) -> dict[bytes, int]:
    """Ranks by token, from the content of a rank file (a base64 token and its rank per line)."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines.splitlines())}


def _ranges(pattern: str) -> list[tuple[int, int]]:
    """The code points of a character class, as the library's own pattern engine knows them."""
    import tiktoken

    every = "".join(map(chr, [*range(0xD800), *range(0xE000, sys.maxunicode + 1)]))
    single = tiktoken.Encoding(
        "class", pat_str=pattern, mergeable_ranks={bytes([i]): i for i in range(256)}, special_tokens={}
    )
    points = np.array([ord(c) for c in bytes(single.encode_ordinary(every)).decode()])
    cut = np.flatnonzero(np.diff(points) > 1) + 1
    return [(int(part[0]), int(part[-1])) for part in np.split(points, cut)]


@lru_cache(maxsize=4)
def spelt_out(pattern: str) -> tuple[str, str, str]:
    """``pattern`` for texts up to U+00FF, up to U+FFFF, and for all others.

    Letters, numbers and spaces are spelt out as the library's engine has them, so that characters
    of newer Unicode versions are cut as there; fewer ranges make the short forms fast. Listing every
    character takes 100 MB for a moment, so the driver does it for all tasks.
    """
    classes = {name: _ranges(name) for name in (r"\p{L}", r"\p{N}", r"\s")}

    def spelt(top: int) -> str:
        inside = {
            name: "".join(f"\\U{a:08x}-\\U{min(b, top):08x}" for a, b in ranges if a <= top)
            for name, ranges in classes.items()
        }
        out, in_class, i = [], False, 0
        while i < len(pattern):
            name = next((n for n in (*inside, r"\S") if pattern.startswith(n, i)), None)
            if name == r"\S":
                out.append(f"[^{inside[chr(92) + 's']}]")
            elif name:
                out.append(inside[name] if in_class else f"[{inside[name]}]")
            else:
                in_class = {"[": True, "]": False}.get(pattern[i], in_class)
                out.append(pattern[i])
            i += len(name or " ")
        return "".join(out)

    return spelt(0xFF), spelt(0xFFFF), spelt(sys.maxunicode)


@lru_cache(maxsize=4)
def _compiled(spelt: tuple[str, str, str]) -> tuple[re.Pattern, ...]:
    return tuple(map(re.compile, spelt))


def pre_tokens(text: str, pattern: str | tuple[str, str, str]) -> Iterator[list[str]]:
    """All matches in order, in lists of a bounded length if the text is long. ``pattern`` may be
    ``spelt_out`` before."""
    latin, basic, full = _compiled(spelt_out(pattern) if isinstance(pattern, str) else pattern)
    if text.isascii():
        chosen = latin
    else:
        try:
            text.encode("latin-1")
            chosen = latin
        except UnicodeEncodeError:
            chosen = basic if len(text.encode("utf-16-le")) == 2 * len(text) else full
    if len(text) <= LONG_TEXT:
        yield chosen.findall(text)
        return
    found = (m.group() for m in chosen.finditer(text))
    while part := list(islice(found, MATCHES)):
        yield part


def merge(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Token ids of one pre-token: itself if it is a token, else the lowest-rank pair merges first,
    the leftmost of equal ones."""
    if word in ranks:
        return [ranks[word]]
    if len(word) > SHORT_WORD:
        return _merge_long(word, ranks)
    parts = [word[i : i + 1] for i in range(len(word))]
    no_rank = sys.maxsize
    pairs = [ranks.get(a + b, no_rank) for a, b in zip(parts, parts[1:])]
    while pairs:
        least = min(pairs)
        if least == no_rank:
            break
        i = pairs.index(least)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
        del pairs[i]
        if i:
            pairs[i - 1] = ranks.get(parts[i - 1] + parts[i], no_rank)
        if i < len(pairs):
            pairs[i] = ranks.get(parts[i] + parts[i + 1], no_rank)
    return [ranks[p] for p in parts]


def _merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    n = len(word)
    end = list(range(1, n + 1))  # of the part that starts here; 0 once it has been merged away
    before = list(range(-1, n - 1))
    heap = [(ranks[word[i : i + 2]], i, i + 2) for i in range(n - 1) if word[i : i + 2] in ranks]
    heapify(heap)
    while heap:
        _, i, stop = heappop(heap)
        middle = end[i]
        if not middle or middle >= n or end[middle] != stop:
            continue  # one of the two has merged since
        end[i], end[middle] = stop, 0
        if stop < n:
            before[stop] = i
            if (pair := word[i : end[stop]]) in ranks:
                heappush(heap, (ranks[pair], i, end[stop]))
        if (left := before[i]) >= 0 and (pair := word[left:stop]) in ranks:
            heappush(heap, (ranks[pair], left, stop))
    ids, i = [], 0
    while i < n:
        ids.append(ranks[word[i : end[i]]])
        i = end[i]
    return ids


_RANKS: dict[int, dict[bytes, int]] = {}


def _known(lines: bytes) -> dict[bytes, int]:
    key = hash(lines)
    if key not in _RANKS:
        _RANKS.clear()
        _RANKS[key] = read_ranks(lines)
    return _RANKS[key]


def _packed(values: np.ndarray) -> bytes:
    """Compressed 32-bit numbers, byte by byte: small numbers leave the upper bytes empty."""
    planes = np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return zstandard.compress(planes.tobytes(), 3)


def _unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), dtype=np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


#: No byte of a word.
_END = b"\xff"


def _exploder(id_type: pa.DataType, ranks_file, pattern: tuple[str, str, str], buckets: int, block_chars: int):
    """Blocks of documents become rows of two kinds.

    A block numbers its distinct words, the most frequent first. Its head holds the documents (``docs``),
    how many pre-tokens they have up to the end of each (``ends``), the number of the word at each
    position (``at``), and the tokens of words that are tokens themselves (``tokens``, 0 for others,
    else the rank and one more). All other words leave in rows by bucket: ``words``, and the steps
    between their numbers.
    """
    schema = pa.schema(
        [("slot", pa.int64()), ("block", pa.int64()), ("words", pa.binary()), ("steps", pa.binary()),
         ("docs", pa.list_(id_type)), ("ends", pa.list_(pa.int64())), ("at", pa.binary()), ("tokens", pa.binary())]
    )

    def rows(block: int, docs: list, ends: list[int], at: list[np.ndarray], numbers: dict, ranks: dict):
        stream = np.concatenate(at) if at else np.zeros(0, np.uint32)
        by_count = np.argsort(-np.bincount(stream, minlength=len(numbers)), kind="stable")
        number = np.empty(len(by_count), dtype=np.uint32)
        number[by_count] = np.arange(len(by_count))
        spelt = list(numbers)
        tokens = np.zeros(len(spelt), dtype=np.uint32)
        dealt: dict[int, tuple[list, list]] = {}
        for no, first in enumerate(by_count.tolist()):
            word = spelt[first].encode()
            if word in ranks:
                tokens[no] = ranks[word] + 1
                continue
            held = dealt.setdefault(xxhash.xxh3_64_intdigest(word) % buckets, ([], []))
            held[0].append(word)
            held[1].append(no)
        words = pa.array([_END.join(held[0]) for held in dealt.values()], pa.binary())
        steps = [_packed(np.diff(np.array(held[1]), prepend=0)) for held in dealt.values()]
        k = len(dealt)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(dealt), pa.int64()), pa.array(np.full(k, block)),
             pa.array([zstandard.compress(w.as_py(), 3) for w in words], pa.binary()),
             pa.array(steps, pa.binary()), *(pa.nulls(k, schema.field(i).type) for i in range(4, 8))],
            schema=schema,
        )
        yield pa.RecordBatch.from_arrays(
            [pa.array([-1 - block]), pa.array([block]), pa.nulls(1, pa.binary()), pa.nulls(1, pa.binary()),
             pa.array([docs], schema.field("docs").type), pa.array([ends], schema.field("ends").type),
             pa.array([_packed(number[stream])], pa.binary()), pa.array([_packed(tokens)], pa.binary())],
            schema=schema,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = _known(ranks_file.value)
        block = TaskContext.get().partitionId() << 32
        numbers, docs, ends, at, held, n = {}, [], [], [], 0, 0
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py()
                for found in pre_tokens(text, pattern):
                    for word in set(found).difference(numbers):
                        numbers[word] = len(numbers)
                    at.append(np.fromiter(map(numbers.__getitem__, found), np.uint32, len(found)))
                    n += len(found)
                docs.append(doc)
                ends.append(n)
                held += len(text)
                if held >= block_chars:
                    yield from rows(block, docs, ends, at, numbers, ranks)
                    block += 1
                    numbers, docs, ends, at, held, n = {}, [], [], [], 0, 0
        if docs:
            yield from rows(block, docs, ends, at, numbers, ranks)

    return run, schema


def _encoder(id_type: pa.DataType, ranks_file):
    """Words by bucket, each encoded where it first comes; heads pass."""
    schema = pa.schema(
        [("block", pa.int64()), ("steps", pa.binary()), ("sizes", pa.binary()), ("ids", pa.binary()),
         ("docs", pa.list_(id_type)), ("ends", pa.list_(pa.int64())), ("at", pa.binary()), ("tokens", pa.binary())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = _known(ranks_file.value)
        bucket, known = None, {}
        for batch in batches:
            sizes, ids = [], []
            for slot, packed in zip(batch.column(0).to_pylist(), batch.column(2)):
                if not packed.is_valid:
                    sizes.append(None)
                    ids.append(None)
                    continue
                if slot != bucket or len(known) > REMEMBERED:
                    bucket, known = slot, {}
                words = zstandard.decompress(packed.as_py()).split(_END)
                for word in words:
                    if word not in known:
                        known[word] = merge(word, ranks)
                coded = [known[word] for word in words]
                sizes.append(_packed(np.fromiter(map(len, coded), np.uint32, len(coded))))
                ids.append(_packed(np.fromiter(chain.from_iterable(coded), np.uint32)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), batch.column(3), pa.array(sizes, pa.binary()), pa.array(ids, pa.binary()),
                 *(batch.column(i) for i in range(4, 8))],
                schema=schema,
            )

    return run, schema


def _assembler(id_name: str, id_type: pa.DataType):
    """Rows of a block, its head last: each position takes the ids of its word."""
    schema = pa.schema([(id_name, id_type), ("ids", pa.list_(pa.int32()))])

    def documents(tokens: np.ndarray, packs: list, docs: pa.Array, ends: np.ndarray, at: np.ndarray):
        sizes = np.ones(len(tokens), dtype=np.int64)
        starts = np.arange(len(tokens), dtype=np.int64)
        flat, filled = [tokens.astype(np.int32) - 1], len(tokens)
        for steps, sized, ids in packs:
            numbers = np.cumsum(steps, dtype=np.int64)
            sizes[numbers] = sized
            starts[numbers] = filled + np.cumsum(sized, dtype=np.int64) - sized
            flat.append(ids.astype(np.int32))
            filled += len(ids)
        flat = np.concatenate(flat)
        cuts = np.searchsorted(ends, np.arange(ASSEMBLED, ends[-1], ASSEMBLED)) + 1
        for part in np.split(np.arange(len(ends)), np.unique(cuts)):
            if not len(part):
                continue
            before = ends[part[0] - 1] if part[0] else 0
            own = at[before : ends[part[-1]]]
            taken = sizes[own]
            upto = np.concatenate(([0], np.cumsum(taken)))
            values = flat[np.repeat(starts[own] - upto[:-1], taken) + np.arange(upto[-1])]
            offsets = np.concatenate(([0], upto[ends[part] - before]))
            lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values))
            yield pa.RecordBatch.from_arrays([docs.slice(part[0], len(part)), lists], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packs: list[tuple[np.ndarray, ...]] = []
        for batch in batches:
            for i in range(batch.num_rows):
                steps, sizes, ids, docs, ends, at, tokens = (batch.column(c)[i] for c in range(1, 8))
                if steps.is_valid:
                    packs.append(tuple(_unpacked(x.as_py()) for x in (steps, sizes, ids)))
                    continue
                upto = ends.values.to_numpy(zero_copy_only=False)
                given, packs = packs, []
                yield from documents(_unpacked(tokens.as_py()), given, docs.values, upto, _unpacked(at.as_py()))

    return run, schema


def encode(
    docs: DataFrame,
    ranks: bytes,
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per row: id and ``ids`` (array of int), the tokens of the whole text, null as empty.

    ``ranks`` is a rank file's content (base64 tokens with their ranks, which must be 0 to n - 1), at
    most some MB, and is broadcast; ``pattern`` cuts texts into pre-tokens, which are encoded
    separately. Strings of special tokens are ordinary text. An empty text has an empty array, repeated
    and null ids are rows like any other, an empty table gives no rows, other columns are not read.

    1. Texts are cut; a block of documents keeps each distinct word once, and its words' positions as
       one packed array. Words that are tokens themselves are told at once by the table.
    2. All other words are shuffled by buckets of their hash, many in a row, and each distinct word of
       a bucket is encoded once. A block gives a word once however often its texts hold it, so a
       frequent word is no hot key. ``spark.sql.shuffle.partitions`` sets the number of buckets.
    3. Ids return by block, and each position takes those of its word. Blocks hold whole documents of
       ``BLOCK_CHARS`` characters together, or end with one longer document; nothing larger is gathered.
    """
    spark: SparkSession = docs.sparkSession
    rows = docs.select(column(docs, id_col).alias("id"), text_of(docs, text_col).alias("text"))
    id_type = to_arrow_type(rows.schema["id"].dataType)
    shared = spark.sparkContext.broadcast(ranks)
    buckets = BUCKETS_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    run, schema = _exploder(id_type, shared, spelt_out(pattern), buckets, BLOCK_CHARS)
    by_word = rows.mapInArrow(run, from_arrow_schema(schema)).repartition("slot").sortWithinPartitions("slot")
    run, schema = _encoder(id_type, shared)
    coded = by_word.mapInArrow(run, from_arrow_schema(schema))
    by_block = coded.repartition("block").sortWithinPartitions("block", F.col("at").isNotNull())
    run, schema = _assembler(id_col, id_type)
    return by_block.mapInArrow(run, from_arrow_schema(schema))


def _decoder(schema: pa.Schema, at: int, ranks_file):
    """Batches with the bytes of the ids in column ``at``, ``DECODED`` rows at a time: a batch of long
    texts would otherwise stand several times in memory. The bytes taken are the column's own buffer."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _known(ranks_file.value)
        by_id: list[bytes | None] = [None] * (max(known.values(), default=-1) + 1)
        for token, rank in known.items():
            by_id[rank] = token
        table = pa.array(by_id, pa.binary())
        for batch in batches:
            for start in range(0, batch.num_rows, DECODED):
                part = batch.slice(start, DECODED)
                lists = part.column(at)
                found = table.take(lists.flatten())
                sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
                upto = np.concatenate(([0], np.cumsum(sizes)))
                _, width, data = found.buffers()
                cut = np.frombuffer(width, dtype="<i4")[upto + found.offset] if len(found) else np.zeros(len(upto), "<i4")
                valid = pa.array(lists.is_valid().to_numpy(zero_copy_only=False)).buffers()[1]
                out = pa.Array.from_buffers(
                    pa.binary(), len(part), [valid, pa.py_buffer(cut.tobytes()), data or pa.py_buffer(b"")]
                )
                yield pa.RecordBatch.from_arrays([*part.columns, out], schema=schema)

    return run


def decode(encoded: DataFrame, ranks: bytes, ids_col: str = "ids", as_col: str = "decoded") -> DataFrame:
    """``encoded`` with ``as_col`` (binary): the bytes of the tokens, one after the other.

    Ids are joined with the table of token bytes, which is broadcast. Other columns stay; an empty
    array gives no bytes, a null array null, an id outside the table an error.
    """
    shared = encoded.sparkSession.sparkContext.broadcast(ranks)
    fields = [f.name for f in encoded.schema.fields]
    kept = [f for f in fields if f != as_col]
    given = encoded.select(*[column(encoded, c) for c in kept])
    schema = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in given.schema.fields] + [(as_col, pa.binary())])

    run = _decoder(schema, kept.index(ids_col), shared)
    return given.mapInArrow(run, from_arrow_schema(schema))
