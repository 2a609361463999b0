import random
import re

import pytest

from reviewloom.llm import decontaminate
from tests.llm.helpers import corpus, table, words

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def ascii_lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def cut(text):
    return WORD.findall(ascii_lower(text or ""))


def expected(rows, items, window=10):
    windows = {}
    for item, text in items:
        w = cut(text)
        for at in range(max(len(w) - window, 0) + 1 if w else 0):
            windows.setdefault(tuple(w[at : at + window]), set()).add("null" if item is None else str(item))
    out = {}
    for doc, text in rows:
        w, hit, found = cut(text), set(), set()
        for n in {len(x) for x in windows}:
            for at in range(len(w) - n + 1):
                ids = windows.get(tuple(w[at : at + n]))
                if ids:
                    hit |= set(range(at, at + n))
                    found |= ids
        out[doc] = (len(w), len(hit), sorted(found))
    return out


def cases():
    rng = random.Random(5)
    items = [(i, " ".join(words(rng, rng.choice([1, 2, 4, 9, 10, 11, 25]), 30)) + "!") for i in range(25)]
    items += [(30, None), (31, ""), (32, "..."), (33, items[3][1]), (None, "lone null item words"), (34, "ÉA éa ΣΑΣ x")]
    rows = corpus(7, 60)
    for i in range(60):
        text = " ".join(words(rng, 20, 30) + [rng.choice(items)[1] or ""] + words(rng, 15, 30))
        rows.append((1000 + i, text.upper() if i % 7 == 0 else text))
    rows += [(2000, "éa éa σας x"), (2001, "Éa éA ΣΑΣ X"), (2002, "x" * 50_000 + " w1")]
    return [(d, t) for d, t in dict(rows).items()], items


@pytest.mark.parametrize("block", [1 << 26, 2_000])
def test_matches_its_definition(spark, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", block)
    rows, items = cases()
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.contamination(table(spark, rows, extra=True), bench)
    found = {r.doc_id: (r.n_words, r.n_hit, list(r.item_ids)) for r in got.collect()}
    assert found == expected(rows, items)
    assert any(n and n != len(ids) for _, n, ids in found.values())


def test_no_items_or_no_documents(spark):
    bench = spark.createDataFrame([], "item_id long, text string")
    rows = [(1, "a b c"), (2, None)]
    got = decontaminate.contamination(table(spark, rows), bench).collect()
    assert sorted((r.doc_id, r.n_words, r.n_hit) for r in got) == [(1, 3, 0), (2, 0, 0)]
    one = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert decontaminate.contamination(table(spark, []), one).count() == 0


def test_drop_keeps_clean_rows_and_all_columns(spark):
    bench = spark.createDataFrame([(1, "one two three four")], "item_id long, text string")
    rows = [(1, "x One two THREE four y"), (1, "clean"), (None, "one two three four"), (2, None), (3, "a"), (3, "a")]
    docs = table(spark, rows, extra=True)
    kept = decontaminate.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r.text) for r in kept.collect() if r.text) == [(1, "clean"), (3, "a"), (3, "a")]
    assert kept.count() == 4
