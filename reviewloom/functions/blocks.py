"""Token rows of whole partitions as Arrow columns, for operators that look at all reviews of one at once.

What stands around a token is told from its neighbours by arithmetic over all tokens of a block, as one
array operation each, instead of an expression that is evaluated review by review. A block consists of whole
reviews; a partition holds no more text than ``tokens.PARTITION_TEXT``, so its tokens fit in memory.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

#: Tokens that are worked on at once (more if a review is longer), and rows of an Arrow batch returned.
BLOCK_TOKENS = 100_000
BATCH_ROWS = 50_000


def together(rows: DataFrame, key: str) -> DataFrame:
    """Rows such that all of a key stand in one partition: as they are, if they were dealt out by it."""
    plan = rows._jdf.queryExecution().sparkPlan()
    dealt = re.fullmatch(rf"hashpartitioning\(({key}#\d+), \d+\)", plan.outputPartitioning().toString())
    # a bucketed scan counts only with an exchange, as Spark may drop its buckets later
    if dealt and f"Exchange {dealt[0]}, REPARTITION_BY" in plan.toString():
        return rows
    return rows.repartition(key)


def _one_array(column: pa.ChunkedArray | pa.Array) -> pa.Array:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def encoded(column: pa.ChunkedArray) -> tuple[np.ndarray, pa.Array]:
    """Numbers of a column's values, and the values; NULL is the last of them."""
    held = _one_array(column)
    values = pa.concat_arrays([held.dictionary, pa.nulls(1, held.dictionary.type)])
    return held.indices.fill_null(len(held.dictionary)).to_numpy(zero_copy_only=False), values


def taken(column: pa.ChunkedArray, at: np.ndarray) -> pa.Array:
    """Values of a column at some places."""
    found = _one_array(column.take(pa.array(at)))
    return found.dictionary_decode() if pa.types.is_dictionary(found.type) else found


def is_one_of(values: pa.Array, wanted: list[str] | tuple[str, ...]) -> np.ndarray:
    return pc.is_in(values, pa.array(wanted, values.type), skip_nulls=True).to_numpy(zero_copy_only=False)


def numbered(*codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the combinations of codes, and for each the place of its first row."""
    found = codes[0].astype(np.int64)
    for other in codes[1:]:
        found, _ = pd.factorize(found * (int(other.max(initial=0)) + 1) + other)
    found, _ = pd.factorize(found)
    first = np.empty(int(found.max(initial=-1)) + 1, np.int64)
    first[found[::-1]] = np.arange(len(found) - 1, -1, -1)
    return found, first


def upto(flags: np.ndarray) -> np.ndarray:
    """At each place how many flags are set up to it."""
    return np.cumsum(flags, dtype=np.int32)


def last_set(flags: np.ndarray) -> np.ndarray:
    """At each place the last one, up to it, whose flag is set; -1 without one."""
    places = np.arange(len(flags), dtype=np.int32)
    return np.maximum.accumulate(np.where(flags, places, np.int32(-1)), dtype=np.int32)


@dataclass
class Partition:
    """The token rows of a partition in reading order, review after review.

    ``names`` holds the key of each review; ``starts`` where it begins, and the number of rows at its end.
    """

    rows: pa.Table
    names: pa.Array
    starts: np.ndarray

    def blocks(self) -> Iterator[tuple[int, int]]:
        """Ranges of reviews."""
        first = 0
        while first < len(self.starts) - 1:
            beyond = int(np.searchsorted(self.starts, self.starts[first] + BLOCK_TOKENS, "right")) - 1
            last = max(beyond, first + 1)
            yield first, last
            first = last


def _short(column: pa.Array) -> pa.Array:
    """A text column as numbers and the different texts, which take a fraction of its memory."""
    return column.dictionary_encode() if pa.types.is_string(column.type) else column


def read(batches: Iterator[pa.RecordBatch], key: str, order: list[str]) -> Partition | None:
    """A partition's rows by review and reading order, sorted only if they do not stand so already.

    Batches are not held as they come: of the key its changes are kept, and of texts their numbers.
    """
    held, ends, values, total = [], [], [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        runs = pc.run_end_encode(batch.column(key))
        ends.append(runs.run_ends.to_numpy().astype(np.int64) + total)
        values.append(runs.values)
        total += batch.num_rows
        kept = batch.drop_columns([key])
        held.append(pa.RecordBatch.from_arrays([_short(c) for c in kept.columns], names=kept.schema.names))
    if not held:
        return None
    rows = pa.Table.from_batches(held).unify_dictionaries().combine_chunks()
    del held
    pa.default_memory_pool().release_unused()  # what the batches as they came took
    names = _one_array(pa.chunked_array(values)).dictionary_encode()
    review = names.indices.to_numpy()
    new = np.flatnonzero(np.diff(review, prepend=-1))  # a review may go on in the next batch
    review = review[new]
    starts = np.append(np.concatenate(([0], *ends))[:-1][new], total)
    places = [rows.column(c).to_numpy() for c in order]
    if len(names.dictionary) == len(review):
        ahead, same = np.zeros(total - 1, bool), np.ones(total - 1, bool)
        for p in places:
            ahead |= same & (p[1:] > p[:-1])
            same &= p[1:] == p[:-1]
        ahead[starts[1:-1] - 1] = True
        if ahead.all():
            return Partition(rows, names.dictionary.take(pa.array(review)), starts)
    review = np.repeat(review, np.diff(starts))
    at = np.lexsort([*places[::-1], review])
    begins = np.flatnonzero(np.diff(review[at], prepend=-1))
    return Partition(
        rows.take(pa.array(at)), names.dictionary.take(pa.array(review[at][begins])), np.append(begins, total))


def batches_of(columns: dict[str, pa.Array], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Record batches of a limited number of rows."""
    table = pa.Table.from_arrays([columns[name] for name in schema.names], schema=schema)
    yield from table.to_batches(max_chunksize=BATCH_ROWS)
