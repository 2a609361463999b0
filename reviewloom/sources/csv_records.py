"""Records of delimited files whose quoted fields hold line breaks, read by many tasks per file.

A line by itself does not tell whether it begins inside quotes, but it tells where it would end in
either case. Such functions of the two states compose, so every block of a file sums up to one, the
blocks of a file are put in a row, and then each task knows how its block begins.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from reviewloom.operators.lookups import fits_broadcast
from reviewloom.session import land

# Parts of a field: quoted text with doubled quotes, and what else may stand up to the next comma.
_QUOTED = r'"[^"]*+(?:""[^"]*+)*+'
_FIELDS = rf'(?:(?:{_QUOTED}"[^,]*+|(?!")[^,]*+),)*+'
#: A line that ends inside quotes if it begins outside them, or inside.
_OPENS = rf"^{_FIELDS}{_QUOTED}$"
_STAYS_OPEN = rf'^[^"]*+(?:""[^"]*+)*+$|^[^"]*+(?:""[^"]*+)*+"(?!")[^,]*+,{_FIELDS}{_QUOTED}$'

BLOCK = ["source_path", "_block"]
WHOLE, BEGINS, CONTINUES = 0, 1, 2


def ends(line: Column) -> Column:
    """Where a line ends: bit 0 if it begins outside quotes, bit 1 if inside; a set bit is inside."""
    return line.rlike(_OPENS).cast("int") + 2 * line.rlike(_STAYS_OPEN).cast("int")


def _states(codes: np.ndarray, state: int) -> np.ndarray:
    """States after each line, from the state before the first: the last line that ends alike from
    both states decides, and every line after it that swaps them."""
    swaps = np.cumsum(codes == 1)
    fixed = np.where((codes == 0) | (codes == 3), np.arange(len(codes)), -1)
    last = np.maximum.accumulate(fixed)
    base = np.where(last >= 0, codes[last] & 1, state)
    return base ^ ((swaps - np.where(last >= 0, swaps[last], 0)) & 1)


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], int, int]]:
    """Neighbouring rows of one block: its path and start, and the rows from and up to."""
    paths, blocks = batch.column(0).dictionary_encode(), batch.column(1).to_numpy()
    changed = (np.diff(paths.indices.to_numpy()) != 0) | (np.diff(blocks) != 0)
    cuts = [0, *(np.flatnonzero(changed) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        if a < b:
            yield (paths[a].as_py(), int(blocks[a])), a, b


_SUMS = pa.schema([("source_path", pa.string()), ("_block", pa.int64()), ("code", pa.int32())])
_SAME = 2  # ends as it begins


def _sum_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One function per block."""
    held, code = None, _SAME

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([{"source_path": held[0], "_block": held[1], "code": code}], schema=_SUMS)

    for batch in batches:
        codes = batch.column(2).to_numpy()
        for key, a, b in _runs(batch):
            if key != held:
                if held:
                    yield row()
                held, code = key, _SAME
            ended = [int(_states(codes[a:b], state)[-1]) for state in (0, 1)]
            code = ended[code & 1] | ended[code >> 1] << 1
    if held:
        yield row()


_RECORDS = pa.schema([
    ("source_path", pa.string()), ("_block", pa.int64()), ("_place", pa.int64()), ("part", pa.int32()),
    ("record", pa.string())])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of each block, numbered from 0; the parts of those that reach over blocks by themselves."""
    held, state, place, opened, part = None, 0, 0, [], CONTINUES

    def rows(key: tuple[str, int], places: list[int], part: int, texts: list[str]) -> pa.RecordBatch:
        n = len(texts)
        return pa.RecordBatch.from_arrays(
            [pa.array([key[0]] * n, pa.string()), pa.array([key[1]] * n, pa.int64()), pa.array(places, pa.int64()),
             pa.array([part] * n, pa.int32()), pa.array(texts, pa.string())],
            schema=_RECORDS,
        )

    for batch in batches:
        codes, entry, lines = batch.column(2).to_numpy(), batch.column(3).to_numpy(), batch.column(4)
        for key, a, b in _runs(batch):
            if key != held:
                if opened:
                    yield rows(held, [place], part, ["\n".join(opened)])
                held, state, place, opened, part = key, int(entry[a]), 0, [], CONTINUES
            after = _states(codes[a:b], state)
            before = np.concatenate(([state], after[:-1]))
            state = int(after[-1])
            starts = np.flatnonzero(before == 0).tolist()
            texts = lines.slice(a, b - a).to_pylist()
            opened += texts[: starts[0] if starts else b - a]
            if not starts and state:
                continue
            if opened:  # what was open is closed by now
                yield rows(key, [place], WHOLE if part == BEGINS else CONTINUES, ["\n".join(opened)])
                place += part == BEGINS
            found = ["\n".join(texts[i:j]) if j - i > 1 else texts[i] for i, j in zip(starts, [*starts[1:], b - a])]
            opened, part = (texts[starts[-1] :], BEGINS) if state else ([], CONTINUES)
            if state:
                found.pop()
            found = [x for x in found if x.rstrip("\r")]
            yield rows(key, list(range(place, place + len(found))), WHOLE, found)
            place += len(found)
    if opened:
        yield rows(held, [place], part, ["\n".join(opened)])


def _entries(sums: DataFrame) -> DataFrame:
    """Whether each block begins inside quotes: the last block before it that ends alike from both
    states decides, and the blocks after that one that swap them."""
    so_far = Window.partitionBy("source_path").orderBy("_block")
    earlier = so_far.rowsBetween(Window.unboundedPreceding, -1)
    fixed = F.when(F.col("code").isin(0, 3), F.struct(F.col("code").bitwiseAND(1).alias("state"), "swaps"))
    return (
        sums.withColumn("swaps", F.count_if(F.col("code") == 1).over(so_far))
        .withColumn("last", F.last(fixed, ignorenulls=True).over(earlier))
        .withColumn("swapped", F.coalesce(F.lag("swaps").over(so_far), F.lit(0)) - F.coalesce("last.swaps", F.lit(0)))
        .select(*BLOCK, F.coalesce("last.state", F.lit(0)).bitwiseXOR((F.col("swapped") % 2).cast("int")).alias("entry"))
    )


def _joined_parts(parts: DataFrame) -> DataFrame:
    """Records that reach over blocks, as rows of the block where each begins."""
    so_far = Window.partitionBy("source_path").orderBy("_block", F.desc("part"))
    begins = F.when(F.col("part") == BEGINS, F.struct("_block", "_place"))
    texts = F.array_sort(F.collect_list(F.struct("_block", "record")))
    return (
        parts.withColumn("at", F.last(begins, ignorenulls=True).over(so_far))
        .groupBy("source_path", "at").agg(F.array_join(F.transform(texts, lambda x: x["record"]), "\n").alias("record"))
        .select("source_path", "at._block", "at._place", "record")
    )


def read_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Records of UTF-8 files: ``source_path``, 1-based ``row_number`` in the file, ``record``.

    A record ends with a line feed, or a carriage return and one, outside quotes; quotes open at the
    beginning of a field and are doubled inside. Blank records are left out, and so is the first record
    of each file, its header. Files are read in blocks by as many tasks, and landed as records; no file
    is gathered. Records that reach over blocks are put together from their parts, at most two rows a
    block.
    """
    lines = spark.read.text(path, lineSep="\n").select(
        F.col("_metadata.file_path").alias("source_path"), F.col("_metadata.file_block_start").alias("_block"),
        ends(F.col("value")).alias("code"), "value", F.monotonically_increasing_id().alias("_order"),
    )
    sums = land(lines.select(*BLOCK, "code").mapInArrow(_sum_up, from_arrow_schema(_SUMS)), "blocks")
    entries = land(_entries(sums), "entries")
    if fits_broadcast(entries):
        begun = lines.join(F.broadcast(entries), BLOCK)
    else:  # the join leaves lines in no order: blocks are put in order again, each whole in one task
        begun = lines.join(entries, BLOCK).repartition(*BLOCK).sortWithinPartitions(*BLOCK, "_order")
    cut = begun.select(*BLOCK, "code", "entry", "value").mapInArrow(_cut, from_arrow_schema(_RECORDS))
    cut = land(cut, "records")
    records = cut.where(F.col("part") == WHOLE).drop("part").unionByName(_joined_parts(cut.where(F.col("part") != WHOLE)))
    counts = cut.where(F.col("part") != CONTINUES).groupBy(*BLOCK).agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("source_path").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = land(counts.select(*BLOCK, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset")), "block_offsets")
    if fits_broadcast(offsets):
        offsets = F.broadcast(offsets)
    numbered = records.join(offsets, BLOCK).withColumn("row_number", F.col("offset") + F.col("_place"))
    # the header is number 0
    return numbered.where("row_number > 0").select(
        "source_path", "row_number", F.regexp_replace("record", "\r$", "").alias("record"))
