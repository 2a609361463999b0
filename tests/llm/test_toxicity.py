import math
import random
import zlib

import pytest
from pyspark.sql import functions as F

from reviewloom.llm.toxicity import Lexicon, features, fit, held_out, misspell, near_terms, toxicity, whole_lexicon
from tests.llm.helpers import table, words


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_lookup_equals_distances():
    rng = random.Random(2)
    terms = {"stupid": 4.5, "idiot": 4.0, "scum": 2.0, "mor*": 1.5, "worthless": 5.0, "weakling": 3.0}
    lexicon = Lexicon(terms)
    pool = list("stupidworhlecmx")
    tried = {"".join(rng.choice(pool) for _ in range(rng.randrange(1, 9))) for _ in range(3000)}
    for term in ("stupid", "idiot", "scum", "worthless", "weakling", "moron", "mor", "mo"):
        tried |= {term, term[1:], term[:-1], term + "s", "x" + term, term[:2] + term[3:], term[:2] + "q" + term[2:]}
        tried |= {term[:i] + "q" + term[i + 1 :] for i in range(len(term))}
    for word in tried:
        exact = max((w for t, w in terms.items() if word == t or t[-1] == "*" and word.startswith(t[:-1])), default=0.0)
        near = max((w for t, w in terms.items() if t[-1] != "*" and len(t) >= 5 and w >= 4 and distance(t, word) <= 1), default=0.0)
        weight, edits = lexicon.lookup(word)
        assert weight == (exact or near), word
        assert edits == (0 if exact else 1) or not weight


def test_weak_terms_are_sought_too():
    assert whole_lexicon({"scoundrel": 7.6, "weakling": 2.0}).lookup("weaklin") == (2.0, 1)


def test_misspellings_of_all_terms_are_found():
    """Near misses of any whole word of five letters or more, whatever its weight."""
    rng = random.Random(2)
    terms = {"stupid": 3.0, "idiot": 4.0, "scum": 2.0, "mor*": 1.5, "worthless": 5.0, "weakling": 2.0}
    lexicon = whole_lexicon(terms)
    pool = list("stupidworhlecmx")
    tried = {"".join(rng.choice(pool) for _ in range(rng.randrange(1, 9))) for _ in range(3000)}
    for term in ("stupid", "idiot", "scum", "worthless", "weakling", "moron", "mor", "mo"):
        tried |= {term, term[1:], term[:-1], term + "s", "x" + term, term[:2] + term[3:], term[:2] + "q" + term[2:]}
        tried |= {term[:i] + "q" + term[i + 1 :] for i in range(len(term))}
    for word in tried:
        exact = max((w for t, w in terms.items() if word == t or t[-1] == "*" and word.startswith(t[:-1])), default=0.0)
        near = max((w for t, w in terms.items() if t[-1] != "*" and len(t) >= 5 and distance(t, word) <= 1), default=0.0)
        weight, edits = lexicon.lookup(word)
        assert weight == (exact or near), word
        assert edits == (0 if exact else 1) or not weight


def test_swapped_neighbours_are_one_edit():
    terms = {"stupid": 3.0, "idiot": 4.0, "scum": 2.0, "dim": 2.5}
    lexicon = whole_lexicon(terms)
    for term in ("stupid", "idiot", "scum"):
        for i in range(len(term) - 1):
            word = term[:i] + term[i + 1] + term[i] + term[i + 2 :]
            assert lexicon.lookup(word) == (terms[term], 0 if word == term else 1), word
    assert features("you idoit", lexicon)[1] > 0
    for word in ("scam", "scums", "dmi", "idt", "tsupdi"):
        assert lexicon.lookup(word) == (0.0, 0), word


def test_quotations_are_told_apart():
    lexicon = Lexicon({"idiot": 4.0})
    meant, quoted = features("you idiot", lexicon), features('he cried "you idiot" and left', lexicon)
    assert meant[0] and not meant[2]
    assert quoted[2] and not quoted[0]
    assert features("she said idiot", lexicon)[2]
    assert features('"open\nidiot', lexicon)[0]  # a quotation ends with its line
    assert features("you idoit idiots", lexicon)[1] > 0
    assert features("", lexicon) == [0.0, 0.0, 0.0, 0.0, 0.0, 1.0]


def labelled(spark, n=400):
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(n):
        w, toxic = words(rng, 30, 200), i % 5 == 0
        if toxic:
            w[rng.randrange(30)] = rng.choice(["worthless", "stupid", "Stupid", "wortless"])
        rows.append((i, " ".join(w)))
        labels.append((i, 1, int(toxic)))
    rows += [(n, None), (n + 1, ""), (None, "stupid"), (n + 2, "word " * 20_000 + "stupid"), (0, rows[0][1])]
    labels += [(None, 1, 1), (n + 1, 1, None), (0, 1, 1), (99_999, 1, 1)]
    return table(spark, rows, extra=True), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_rows_are_found(spark):
    docs, labels = labelled(spark)
    got = toxicity(docs, labels).collect()
    assert len(got) == 405
    for r in got:
        if r.doc_id is not None:
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
    held = [r for r in got if r.held_out and r.doc_id < 400]
    assert len(held) > 50
    assert sum(r.predicted == (r.doc_id % 5 == 0) for r in held) >= 0.95 * len(held)
    empty = {r.score for r in got if r.doc_id in (400, 401)}
    assert len(empty) == 1 and empty.pop() < 0.3


def test_held_out_labels_do_not_matter(spark):
    docs, labels = labelled(spark, 200)
    flipped = labels.withColumn("toxic", F.when(held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = fit(docs, labels), fit(docs, flipped)
    assert a.terms == b.terms and a.weights == pytest.approx(b.weights)


def test_redundant_stems_take_no_place(spark):
    docs, labels = labelled(spark)
    terms = fit(docs, labels, max_terms=4).terms
    assert set(terms) == {"wort*", "worthless", "stupid", "wortless"}


def test_no_labels_and_no_rows(spark):
    docs, labels = labelled(spark, 50)
    none = labels.limit(0)
    assert {r.predicted for r in toxicity(docs, none).collect()} == {0}
    assert toxicity(docs.limit(0), labels).count() == 0


def test_misspelling_is_one_edit_and_repeatable():
    terms = {"stupid": 3.0, "idiot": 4.0, "scum": 2.0, "aab": 2.0, "boooo": 1.0, "mor*": 1.0}
    lexicon = whole_lexicon(terms)
    text = "You Stupid IDIOT, scum aab boooo moron " * 9
    wrong = misspell(text, terms)
    assert wrong == misspell(text, terms) and len(wrong.split()) == len(text.split())
    for a, b in zip(text.lower().split(), wrong.lower().split()):
        a, b = a.strip(","), b.strip(",")
        assert (a == b) == (a in ("you", "aab", "moron")), (a, b)
        if a != b:
            assert lexicon.lookup(b) == (terms[a], 1), (a, b)


def test_fitted_scores_of_misspelt_and_quoted_insults(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    model = fit(docs, labels)
    lexicon = whole_lexicon(model.terms, model.near)

    def score(text):
        logit = sum(a * b for a, b in zip(features(text, lexicon), model.weights))
        return 1 / (1 + math.exp(-logit))

    insults = [t for t in sorted(model.terms, key=model.terms.get) if t[-1] != "*" and len(t) >= 5][-5:]
    harmless = score("you are a friend")
    for insult in insults:
        wrong = misspell(f"you are a {insult}", model.terms)
        assert insult not in wrong
        quoted = score(f'he wrote "you are a {insult}" there')
        assert score(f"you are a {insult}") >= score(wrong) > harmless
        assert score(f"you are a {insult}") > quoted >= harmless
    assert min(model.weights[:-1]) >= 0


def test_terms_near_a_word_are_those_within_one_edit():
    terms = {"stupid": 3.0, "idiot": 4.0, "scum": 2.0, "idiom": 1.0, "mor*": 1.0}
    find, whole = near_terms(list(terms)), {t: whole_lexicon({t: 1.0}) for t in terms}
    rng = random.Random(4)
    tried = {"".join(rng.choice("idotscumpr") for _ in range(rng.randrange(1, 8))) for _ in range(2000)}
    for t in terms:
        tried |= {t, t[1:], t + "x", t[:2] + "q" + t[2:], t[:1] + t[2:3] + t[1:2] + t[3:]}
    for word in tried - set(terms):
        assert set(find(word)) == {t for t in terms if t[-1] != "*" and whole[t].lookup(word)[1]}, word


def test_misspellings_common_in_clean_rows_weigh_less(spark):
    docs = [(i, "a stupid thing said often" if i % 2 else "a studid stuffing thing") for i in range(200)]
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(200)], "doc_id long, quality int, toxic int")
    model = fit(table(spark, docs), labels)
    assert model.near["stupid"] < 1 < model.terms["stupid"]
