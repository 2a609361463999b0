"""Line deduplication over range-partitioned line hashes; decisions travel as keep bitmaps."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_type

from reviewloom.llm.common import SPACES, column, text_of
from reviewloom.session import land

BATCH_LINES = 50_000


def _line_rows(id_type: pa.DataType, min_chars: int):
    schema = pa.schema(
        [("h1", pa.int64()), ("h2", pa.int64()), ("id", id_type), ("text_key", pa.int64()),
         ("line", pa.int32()), ("n_lines", pa.int32())]
    )

    def rows(batch: pa.RecordBatch, digests: bytearray, where: list, lines: list, counts: list):
        n, at = len(lines), pa.array(where, pa.int32())
        halves = np.frombuffer(bytes(digests), dtype="<i8").reshape(n, 2)
        return pa.RecordBatch.from_arrays(
            [pa.array(halves[:, 0]), pa.array(halves[:, 1]), batch.column(0).take(at),
             batch.column(1).take(at), pa.array(lines, pa.int32()), pa.array(counts, pa.int32())],
            schema=schema,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, where, lines, counts = bytearray(), [], [], []
            for at in range(batch.num_rows):
                parts = batch.column(2)[at].as_py().split("\n")
                for i, part in enumerate(parts):
                    stripped = part.strip(SPACES)
                    if len(stripped) >= min_chars:
                        digests += xxhash.xxh3_128_digest(stripped.encode().lower())
                        where.append(at)
                        lines.append(i)
                        counts.append(len(parts))
                if len(lines) >= BATCH_LINES:
                    yield rows(batch, digests, where, lines, counts)
                    digests, where, lines, counts = bytearray(), [], [], []
            if lines:
                yield rows(batch, digests, where, lines, counts)

    return run, schema


def _stream(id_type: pa.DataType):
    """Walk the sorted rows of one range: every line of a key outside its first document goes.

    The lines of the first document of the range's first key are only marked, since an earlier
    range may have begun that key; the first and last key of the range are told along.
    """
    schema = pa.schema(
        [("part", pa.int32()), ("kind", pa.int32()), ("id", id_type), ("text_key", pa.int64()),
         ("line", pa.int32()), ("n_lines", pa.int32()), ("h1", pa.int64()), ("h2", pa.int64())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        last = head = None  # the key of the row before, and the first document holding it
        first = None
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            h1, h2 = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            # one number per document within the batch: rows of a key are sorted by document
            ids = batch.column(2)
            codes = ids.dictionary_encode(null_encoding="encode").indices.to_numpy()
            starts = np.r_[True, (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])]
            if first is None:
                first = (h1[0], h2[0])
            carried = last == (h1[0], h2[0])
            at = np.maximum.accumulate(np.where(starts, np.arange(n), 0))
            goes = codes != codes[at]
            run_end = int(np.argmax(starts[1:])) + 1 if starts[1:].any() else n
            if carried:  # the first run goes on: its first document stands in an earlier batch
                goes[:run_end] = [x != head for x in ids.slice(0, run_end).to_pylist()]
            marked = np.zeros(n, dtype=bool)
            if first == (h1[0], h2[0]):
                marked[:run_end] = ~goes[:run_end]
            take = np.flatnonzero(goes | marked)
            if len(take):
                index = pa.array(take)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(take), part, dtype=np.int32)),
                     pa.array(marked[take].astype(np.int32)),
                     *[batch.column(c).take(index) for c in (2, 3, 4, 5, 0, 1)]],
                    schema=schema,
                )
            if not carried or run_end < n:
                head = ids[int(at[-1])].as_py()
            last = (h1[-1], h2[-1])
        if first is not None:
            none = [None, None]
            yield pa.RecordBatch.from_pydict(
                {"part": [part] * 2, "kind": [2, 3], "id": none, "text_key": none, "line": none,
                 "n_lines": none, "h1": [first[0], last[0]], "h2": [first[1], last[1]]},
                schema=schema,
            )

    return run, schema


def _bitmap(n_lines: int, dropped: list[int]) -> bytes:
    keep = np.ones(n_lines, dtype=bool)
    keep[dropped] = False
    return zlib.compress(np.packbits(keep).tobytes())


def line_keep_bitmaps(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10
) -> DataFrame:
    """Documents that lose lines: id, ``text_key``, ``n_dropped``, ``keep_bitmap``.

    A line's key is the line stripped of ASCII white space with A-Z lowered; keys of at least
    ``min_chars`` code points held by several documents stay in the smallest id only (a null id
    sorts last, rows with one id are one document). Keys are 128-bit hashes, range-partitioned
    together with the document, so that a hot line spreads over ranges in order; each range is
    streamed once. A range whose first key continues an earlier range's last key drops the marked
    lines as well: one comparison per range. Bitmaps are zlib-compressed packed bits, bit 1 = keep.
    ``text_key`` (hash of the text) tells apart rows of one id with different texts.
    """
    rows = docs.select(
        column(docs, id_col).alias("id"),
        F.xxhash64(text_of(docs, text_col)).alias("text_key"),
        text_of(docs, text_col).alias("text"),
    )
    id_type = to_arrow_type(rows.schema["id"].dataType)
    split, split_schema = _line_rows(id_type, min_chars)
    lines = rows.mapInArrow(split, from_arrow_schema(split_schema))
    id_order = F.col("id").asc_nulls_last()
    ranges = lines.repartitionByRange("h1", "h2", id_order)
    stream, stream_schema = _stream(id_type)
    found = land(
        ranges.sortWithinPartitions("h1", "h2", id_order).mapInArrow(
            stream, from_arrow_schema(stream_schema)
        ),
        "lines",
    )
    edges = found.where("kind >= 2").select("part", "kind", "h1", "h2").orderBy("part", "kind")
    continued, last = [], None
    for edge in edges.collect():  # two rows per range, whatever the input
        if edge.kind == 2 and last == (edge.h1, edge.h2):
            continued.append(edge.part)
        last = (edge.h1, edge.h2)
    gone = found.where((F.col("kind") == 0) | ((F.col("kind") == 1) & F.col("part").isin(continued)))

    @F.pandas_udf(T.BinaryType())
    def bitmap(n_lines: pd.Series, dropped: pd.Series) -> pd.Series:
        return pd.Series([_bitmap(n, d) for n, d in zip(n_lines, dropped)])

    per_doc = gone.groupBy("id", "text_key").agg(
        F.max("n_lines").alias("n_lines"), F.collect_set("line").alias("lines")
    )
    return per_doc.select(
        F.col("id").alias(id_col),
        "text_key",
        F.size("lines").cast("long").alias("n_dropped"),
        bitmap("n_lines", "lines").alias("keep_bitmap"),
    )


@F.pandas_udf(T.StringType())
def kept_text(text: pd.Series, keep_bitmap: pd.Series) -> pd.Series:
    """The text's lines whose bit is set, joined by line feeds; the whole text without a bitmap."""

    def one(whole: str, packed: bytes | None) -> str:
        if packed is None:
            return whole
        keep = np.unpackbits(np.frombuffer(zlib.decompress(packed), dtype=np.uint8))
        return "\n".join(x for x, k in zip(whole.split("\n"), keep) if k)

    return pd.Series([one(t, b) for t, b in zip(text, keep_bitmap)], dtype=object)


def with_bitmaps(
    docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``docs`` with ``__keep_bitmap`` and ``__n_dropped`` (null where no line goes).

    Bitmaps are few and small beside texts: they are hashed, so that texts are not sorted.
    """
    marks = bitmaps.select(
        column(bitmaps, id_col).alias("id"), "text_key", "keep_bitmap", "n_dropped"
    ).hint("shuffle_hash")
    on = column(docs, id_col).eqNullSafe(marks["id"]) & (
        F.xxhash64(text_of(docs, text_col)) == marks["text_key"]
    )
    return docs.join(marks, on, "left").select(
        *[column(docs, c) for c in docs.columns],
        marks["keep_bitmap"].alias("__keep_bitmap"),
        marks["n_dropped"].alias("__n_dropped"),
    )


def drop_repeated_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = 10,
    chars_col: str | None = "n_chars",
) -> DataFrame:
    """``docs`` with repeated lines removed from the text; all rows and columns stay.

    A text that loses all its lines becomes empty; null texts stay null. ``chars_col``, where
    present, is set to the new length of changed texts.
    """
    marked = with_bitmaps(docs, line_keep_bitmaps(docs, id_col, text_col, min_chars), id_col, text_col)
    changed = F.col("__keep_bitmap").isNotNull()
    text = F.when(changed, kept_text(text_of(docs, text_col), F.col("__keep_bitmap"))).otherwise(
        column(docs, text_col)
    )
    out = marked.withColumn("__text", text)
    chars = F.when(changed, F.length("__text").cast("long")).otherwise(
        column(docs, chars_col) if chars_col in docs.columns else F.lit(None)
    )
    return out.select(
        *[
            (F.col("__text") if c == text_col else chars if c == chars_col else column(docs, c)).alias(c)
            for c in docs.columns
        ]
    )
