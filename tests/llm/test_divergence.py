import random
import re

import pytest

from reviewloom.llm import divergence
from tests.llm.helpers import table

TERM = re.compile("[a-z\x80-\U0010ffff]+")
UPPER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def plain(docs, least_docs, top):
    """All rows by the definition, in Python's integers."""
    counts, held, groups = {}, {}, set()
    for i, (text, lang, source) in enumerate(docs):
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        for term in TERM.findall((text or "").translate(UPPER)):
            counts[lang, source, term] = counts.get((lang, source, term), 0) + 1
            held.setdefault((lang, term), set()).add(i)
    kept = {}
    for (lang, term), where in held.items():
        if len(where) >= least_docs:
            kept.setdefault(lang, []).append(term)

    def share(n, total, v):
        return 1 + (10**9 * (n + 5)) // (total + 5 * v)

    out = []
    for lang, source in groups:
        terms = kept.get(lang, [])
        of = {s: [counts.get((lang, s, t), 0) for t in terms] for g, s in groups if g == lang}
        whole = [sum(c) for c in zip(*of.values())]
        shares = {s: [share(n, sum(ns), len(terms)) for n in ns] for s, ns in of.items()}
        own = shares[source]
        pairs = [(sum(abs(a - b) for a, b in zip(own, p)), s) for s, p in shares.items() if s != source]
        marks = [
            (p - q, t)
            for t, n, p, q in zip(terms, of[source], own, [share(n, sum(whole), len(terms)) for n in whole])
            if n > 0 and p > q
        ]
        for part, found, limit in (("pair", pairs, None), ("term", marks, top)):
            found.sort(key=lambda x: (-x[0], x[1].encode()))
            out += [(lang, source, part, item, value, i + 1) for i, (value, item) in enumerate(found[:limit])]
    return sorted(out)


def rows(found):
    return sorted(map(tuple, found.select("lang", "source", "part", "item", "value", "rank").collect()))


def documents(n, n_sources, seed=2):
    rng = random.Random(seed)
    vocabulary = [f"w{c}{d}" for c in "abcdefghij" for d in "klmnop"] + ["É", "é", "straße", "日本", "don't", "x1y"]
    docs = []
    for i in range(n):
        lang, source = rng.choice(["en", "en", "fr", None, ""]), f"s{min(int(rng.expovariate(0.2)), n_sources - 1)}"
        low = hash((source, 1)) % 20 if rng.random() < 0.5 else 0
        words = rng.choices(vocabulary[low:], k=rng.choice([0, 1, 5, 30, 200]))
        docs.append((" ".join(words).upper() if i % 7 == 0 else " ".join(words), lang, source))
    docs += [(None, "en", "only null"), ("", "en", None), ("w", "de", "alone"), ("123 _ -", "it", "a"), (None, "it", "b")]
    return docs + [docs[3]] * 3


def given(spark, docs, extra=False):
    return table(spark, [(i, *d, 0) for i, d in enumerate(docs)], extra)


@pytest.mark.parametrize("group_block, term_block, held", [(16, 4096, 400_000), (3, 7, 50), (1, 1, 1)])
def test_equals_the_definition(spark, monkeypatch, group_block, term_block, held):
    docs = documents(160, 8)
    for name, value in (("GROUP_BLOCK", group_block), ("TERM_BLOCK", term_block), ("HELD", held)):
        monkeypatch.setattr(divergence, name, value)
    found = divergence.divergences(given(spark, docs, extra=True), least_docs=5, top_terms=6)
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert rows(found) == plain(docs, 5, 6)


def test_no_kept_terms_and_empty_table(spark):
    docs = [("a b", "en", "x"), ("a", "en", "y"), (None, "en", "z"), ("a", "fr", "x")]
    assert rows(divergence.divergences(given(spark, docs))) == plain(docs, 30, 50)
    assert divergence.divergences(given(spark, [])).count() == 0


def test_shares_of_large_counts_are_exact(spark):
    from pyspark.sql import functions as F

    cases = [(10**12, 3 * 10**12, 10**6), (0, 0, 1), (10**17, 10**17 + 1, 7), (999, 1000, 3)]
    df = spark.createDataFrame(cases, "n long, total long, v long")
    got = [r[0] for r in df.select(divergence._share(F.col("n"), F.col("total"), F.col("v"))).collect()]
    assert got == [1 + 10**9 * (n + 5) // (t + 5 * v) for n, t, v in cases]


def test_long_text(spark):
    docs = [(" ".join(f"w{chr(97 + i % 26)}" for i in range(60_000)), "en", "a")] + [("wa wb", "en", "b")] * 3
    assert rows(divergence.divergences(given(spark, docs), least_docs=2)) == plain(docs, 2, 50)
