import math
import random
import re

import pytest

from reviewloom.llm import lexical_search
from reviewloom.llm.queries import op12_lexical_search
from tests.llm.helpers import CLASHING, corpus, table

TERM = re.compile("[0-9a-z\x80-\U0010ffff]+")
UPPER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def terms(text):
    return TERM.findall((text or "").translate(UPPER))


def plain(docs, items, top=10):
    """(item, rank, score, id) by the definition, one document and item at a time."""
    cut = [(d, terms(t)) for d, t in docs]
    n_docs, n_terms = sum(bool(w) for _, w in cut), sum(len(w) for _, w in cut)
    df = {}
    for _, w in cut:
        for term in set(w):
            df[term] = df.get(term, 0) + 1
    wanted = {}
    for item, text in items:
        wanted.setdefault(item, set()).update(terms(text))
    out = []
    for item, held in wanted.items():
        found = []
        for d, w in cut:
            if not w:
                continue
            m = 100 - 90 + (90 * len(w) * n_docs) // n_terms
            score = 0
            for term in held & set(w):
                tf = w.count(term)
                weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[term] + 1)))
                score += weight * ((1000000000 * tf) // (1000 * tf + 8 * m))
            if score > 0:
                found.append((-score, d is None, d, score))
        found.sort(key=lambda x: x[:2] + (x[2] or 0,))
        out += [(item, i + 1, x[3], x[2]) for i, x in enumerate(found[:top])]
    return sorted(out, key=repr)


def rows(found):
    return sorted(((r[0], r["rank"], r["score"], r[2]) for r in found.collect()), key=repr)


def items_table(spark, items, kind="long"):
    df = spark.createDataFrame(items, f"item_id {kind}, text string")
    return df.selectExpr("*", *[f"'x' as `{c}`" for c in CLASHING])


def test_terms_are_matched_whole():
    scan = lexical_search._automaton([b"ab", b"b", b"\xc3\xa9t\xc3\xa9", b"1"])
    text = f" {lexical_search.cleaned('AB b,b ab1 abab étéÉté ÉTÉ été 1').decode('latin-1')} "
    found = [n for _, n in scan.iter(text)]
    assert sorted(found) == [0, 1, 1, 2, 3] and lexical_search.terms_of("İ-a_B\x7fc") == ["İ".encode(), b"a", b"b", b"c"]


@pytest.mark.parametrize("scored", [7, lexical_search.SCORED])
def test_equals_the_definition(spark, monkeypatch, scored):
    rng = random.Random(4)
    docs = [(d, t) for d, t in corpus(21, 80)] + [(None, "w1 w2"), (5, "w1 w1"), (5, "w1 w1"), (900, "W7 w7\nw8-w9")]
    items = [(i, " ".join(f"w{rng.randrange(400)}" for _ in range(rng.choice([1, 3, 20])))) for i in range(15)]
    items += [(99, None), (98, ""), (97, "nowhere"), (3, "w1 w2 w3"), (None, "w5 É"), (96, "w7 " * 500)]
    monkeypatch.setattr(lexical_search, "SCORED", scored)
    found = lexical_search.search(table(spark, docs, extra=True), items_table(spark, items))
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert rows(found) == plain(docs, items)


def test_equal_scores_go_by_id_and_items_may_be_named(spark):
    docs = [(i, "same words here") for i in range(30, 0, -1)] + [(31, "other")]
    found = lexical_search.search(
        table(spark, docs).repartition(5), items_table(spark, [("a", "words"), ("b", "same here")], "string"), top=4
    )
    assert [(r[0], r[1], r[2]) for r in found.orderBy("item_id", "rank").collect()] == [
        (i, n, n) for i in "ab" for n in range(1, 5)
    ]


def test_item_blocks_and_empty_tables(spark, monkeypatch):
    docs = corpus(8, 30)
    items = [(i, f"w{i} w{i + 1} w{i + 40}") for i in range(9)]
    whole = rows(lexical_search.search(table(spark, docs), items_table(spark, items)))
    monkeypatch.setattr(lexical_search, "TERM_BYTES", 25)
    assert rows(lexical_search.search(table(spark, docs), items_table(spark, items))) == whole == plain(docs, items)
    assert lexical_search.search(table(spark, []), items_table(spark, items)).count() == 0
    assert lexical_search.search(table(spark, docs), items_table(spark, [])).count() == 0
    assert lexical_search.search(table(spark, [(1, None), (2, " ")]), items_table(spark, items)).count() == 0


def test_query_equals_the_definition_on_the_given_tables(spark):
    folder = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    assert rows(op12_lexical_search(spark, folder)) == plain(docs, items)
