"""Ranked lexical search without an index: one automaton of all query terms scans the texts."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import itemgetter

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_type
from pyspark.sql.window import Window

from reviewloom.llm.common import column, text_batches, text_of
from reviewloom.session import land

#: Every byte outside terms becomes a blank, A-Z are lowered; bytes of other letters stay.
_TABLE = bytes(
    i | 0x20 if 0x41 <= i <= 0x5A else i if 0x30 <= i <= 0x39 or 0x61 <= i <= 0x7A or i >= 0x80 else 0x20
    for i in range(256)
)
#: Scores that a task adds up at once.
SCORED = 1_000_000
#: Largest size of the automaton's terms that is broadcast; item sets beyond are searched in blocks.
TERM_BYTES = 64 << 20


def cleaned(text: str) -> bytes:
    """Lowered terms with blanks for all else."""
    return text.encode().translate(_TABLE)


def terms_of(text: str) -> list[bytes]:
    return cleaned(text).split()


def _automaton(terms: list[bytes]):
    """Finds ``terms`` between blanks; a byte is taken as one character."""
    found = ahocorasick.Automaton()
    for number, term in enumerate(terms):
        found.add_word(f" {term.decode('latin-1')} ", number)
    found.make_automaton()
    return found


def _scanner(id_type: pa.DataType, terms):
    """Per text: its id, how many terms it has, and how often which item terms."""
    schema = pa.schema(
        [("id", id_type), ("n", pa.int64()), ("terms", pa.list_(pa.int32())), ("tfs", pa.list_(pa.int64()))]
    )
    number = itemgetter(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton(terms.value) if terms.value else None
        for batch in batches:
            lengths, numbers, tfs = [], [], []
            for text in batch.column(1):
                text = cleaned(text.as_py())
                lengths.append(len(text.split()))
                guarded = f" {text.decode('latin-1')} "
                counted = Counter(map(number, automaton.iter(guarded))) if automaton else {}
                numbers.append(list(counted))
                tfs.append(list(counted.values()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(lengths, pa.int64()), pa.array(numbers, schema.field(2).type),
                 pa.array(tfs, schema.field(3).type)],
                schema=schema,
            )

    return run, schema


@dataclass(frozen=True)
class Outputs:
    """What a term of the automaton means: its weight, and the numbers of the items that have it."""

    weight: np.ndarray
    first: np.ndarray
    size: np.ndarray
    items: np.ndarray
    n_items: int


class _Best:
    """The ``top`` best (score, document) per item among those shown."""

    def __init__(self, n_items: int, top: int) -> None:
        self.top = top
        self.item = np.zeros(0, np.int64)
        self.score = np.zeros(0, np.int64)
        self.rows: pa.Array | None = None
        self.floor = np.zeros(n_items, np.int64)

    def show(self, item: np.ndarray, score: np.ndarray, ids: pa.Array) -> None:
        good = np.flatnonzero((score > 0) & (score >= self.floor[item]))
        if not len(good):
            return
        item, score, ids = item[good], score[good], ids.take(pa.array(good))
        if self.rows is not None:
            item, score = np.concatenate((self.item, item)), np.concatenate((self.score, score))
            ids = pa.concat_arrays([self.rows, ids])
        by_id = pc.rank(ids, sort_keys="ascending", null_placement="at_end", tiebreaker="dense")
        order = np.lexsort((by_id.to_numpy(zero_copy_only=False), -score, item))
        sorted_items = item[order]
        place = np.arange(len(order)) - np.searchsorted(sorted_items, sorted_items)
        kept = order[place < self.top]
        self.item, self.score, self.rows = item[kept], score[kept], ids.take(pa.array(kept))
        last = order[place == self.top - 1]
        self.floor[item[last]] = score[last]


def _ranker(id_type: pa.DataType, outputs, n_docs: int, n_terms: int, top: int, scored: int):
    """The best rows of a task for each item, from the counts of its texts."""
    schema = pa.schema([("item", pa.int32()), ("id", id_type), ("score", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: Outputs = outputs.value
        best = _Best(out.n_items, top)
        for batch in batches:
            term = batch.column(2).flatten().to_numpy()
            tf = batch.column(3).flatten().to_numpy()
            held = np.diff(batch.column(2).offsets.to_numpy())
            n = batch.column(1).to_numpy()
            m = 100 - 90 + (90 * n * n_docs) // max(n_terms, 1)
            row = np.repeat(np.arange(batch.num_rows), held)
            part = out.weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[row]))
            # cut between texts, so that about ``scored`` outputs are added up at a time
            upto = np.cumsum(np.bincount(row, out.size[term], batch.num_rows))
            cuts = np.searchsorted(upto, np.arange(scored, upto[-1] if len(upto) else 0, scored)) + 1
            for rows in np.split(np.arange(batch.num_rows), np.unique(cuts)):
                if not len(rows):
                    continue
                low, high = np.searchsorted(row, (rows[0], rows[-1] + 1))
                own, size = term[low:high], out.size[term[low:high]]
                at = np.repeat(out.first[own] - (np.cumsum(size) - size), size) + np.arange(size.sum())
                key = np.repeat(row[low:high], size).astype(np.int64) * out.n_items + out.items[at]
                order = np.argsort(key, kind="stable")
                key, shares = key[order], np.repeat(part[low:high], size)[order]
                starts = np.flatnonzero(np.diff(key, prepend=-1))
                if len(starts):
                    sums = np.add.reduceat(shares, starts)
                    best.show(key[starts] % out.n_items, sums, batch.column(0).take(pa.array(key[starts] // out.n_items)))
        if best.rows is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(best.item.astype(np.int32)), best.rows, pa.array(best.score)], schema=schema
            )

    return run, schema


def _item_blocks(items: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple[object, set[bytes]]]]:
    """Item ids with their terms, in blocks whose texts hold ``TERM_BYTES`` at most (or one item)."""
    rows = items.select(column(items, id_col).alias("id"), text_of(items, text_col).alias("text"))
    block: dict[object, set[bytes]] = {}
    held = 0
    for row in rows.orderBy("id").toLocalIterator():
        size = len(row.text.encode())
        if block and held + size > TERM_BYTES and row.id not in block:
            yield list(block.items())
            block, held = {}, 0
        block.setdefault(row.id, set()).update(terms_of(row.text))
        held += size
    if block:
        yield list(block.items())


def search(
    docs: DataFrame,
    items: DataFrame,
    top: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """Per item the ``top`` documents with the highest score above 0: item id, ``rank`` (from 1),
    document id, ``score``.

    Terms are maximal runs of ASCII letters and digits and of characters beyond ASCII; only A-Z are
    lowered. A term's weight falls with the documents that hold it, its share of a score rises with its
    count and falls with the document's length; weights are taken in doubles, all else in 64-bit integers.

    Null texts have no terms. Rows that repeat an item id are one item with the terms of all; rows that
    repeat a document id are documents of their own; a null id is an id like any other and sorts last.
    Equal scores are ranked by id. Items without terms, without finds, and empty tables give no rows;
    other columns are not read.

    1. The terms of all items go into one automaton, each between blanks, which is broadcast (items are
       searched in blocks of ``TERM_BYTES``). It is led over every whole text, in which all that is no
       term is blank, so it counts terms and nothing inside longer ones; the counts are landed.
    2. Document counts per term, documents and terms are grouped sums of that table.
    3. Each task maps the automaton's outputs to items and keeps the best ``top`` rows per item; what
       the tasks kept is ranked.
    """
    parts = [
        _search_block(docs, block, top, id_col, text_col) for block in _item_blocks(items, item_col, item_text_col)
    ]
    id_type, item_type = docs.schema[id_col].dataType, items.schema[item_col].dataType
    names = f"`item` int, `rank` int, `id` {id_type.simpleString()}, `score` bigint, `item_key` {item_type.simpleString()}"
    found = docs.sparkSession.createDataFrame([], names)
    for part, keys in parts:
        labels = docs.sparkSession.createDataFrame(
            list(enumerate(keys)), f"`number` int, `item_key` {item_type.simpleString()}"
        )
        found = found.unionByName(part.join(F.broadcast(labels), F.col("item") == F.col("number")).drop("number"))
    return found.select(
        F.col("item_key").alias(item_col), "rank", F.col("id").alias(id_col), "score"
    )


def _search_block(docs: DataFrame, block: list, top: int, id_col: str, text_col: str) -> tuple[DataFrame, list]:
    """``item`` (number), ``rank``, ``id``, ``score``, and the items' ids by number."""
    spark: SparkSession = docs.sparkSession
    terms = sorted(set().union(*(held for _, held in block)))
    numbers = {term: i for i, term in enumerate(terms)}
    texts = docs.select(column(docs, id_col).alias("id"), text_of(docs, text_col).alias("text"))
    id_type = to_arrow_type(texts.schema["id"].dataType)
    run, schema = _scanner(id_type, spark.sparkContext.broadcast(terms))
    with text_batches(spark):
        counted = land(texts.mapInArrow(run, from_arrow_schema(schema)), "term-counts")

    whole = counted.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    n_docs, n_terms = int(whole[0]), int(whole[1])
    df = np.zeros(len(terms), dtype=np.int64)
    for row in counted.select(F.explode("terms").alias("term")).groupBy("term").count().toLocalIterator():
        df[row["term"]] = row["count"]

    item_of = [np.fromiter((numbers[t] for t in held), np.int64, len(held)) for _, held in block]
    pair_term = np.concatenate(item_of) if item_of else np.zeros(0, np.int64)
    pair_item = np.repeat(np.arange(len(block)), [len(x) for x in item_of])
    order = np.argsort(pair_term, kind="stable")
    size = np.bincount(pair_term, minlength=len(terms))
    outputs = Outputs(
        np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in df], dtype=np.int64),
        np.cumsum(size) - size, size, pair_item[order], len(block),
    )
    run, schema = _ranker(id_type, spark.sparkContext.broadcast(outputs), n_docs, n_terms, top, SCORED)
    best = counted.where(F.size("terms") > 0).mapInArrow(run, from_arrow_schema(schema))
    by_score = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    ranked = best.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= top)
    return ranked.select("item", "rank", "id", "score"), [key for key, _ in block]
