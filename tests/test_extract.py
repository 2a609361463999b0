"""Extraction: golden sentences, and random reviews against extraction by definition."""

import random

import pytest
from pyspark.sql import functions as F

from reviewloom.operators.extract import JAPANESE_RULES, SPACED_RULES, extract_pairs
from reviewloom.operators.reasons import build_reasons
from tests.walks import Review

COLUMNS = (
    "run_id string, row_id string, review_id string, sentence int, place int, index int, surface string, "
    "pos string, sub_pos string, inflection string, lemma string, polarities array<string>, entity string, "
    "issue_category string"
)


def frame(spark, reviews):
    rows = []
    for key, tokens in reviews.items():
        for i, t in enumerate(tokens):
            rows.append((
                "run", key, f"id_{key}", t["sentence"], i, i, t.get("surface", t["lemma"]), t["pos"], t["sub_pos"],
                t.get("inflection", "*"), t["lemma"], ["negative"] if t.get("hit") else None,
                t.get("entity"), t.get("issue"),
            ))
    return spark.createDataFrame(rows, COLUMNS)


def sentence(*words, number=1):
    """Words as ``lemma/pos/sub_pos`` with a trailing ``!`` for a polarity term."""
    out = []
    for w in words:
        hit = w.endswith("!")
        lemma, pos, *sub = w.rstrip("!").split("/")
        out.append({"sentence": number, "lemma": lemma, "pos": pos, "sub_pos": sub[0] if sub else "自立", "hit": hit})
    return out


def pairs(spark, reviews, rules=JAPANESE_RULES):
    rows = extract_pairs(frame(spark, reviews), rules).collect()
    return {
        (r.row_id, r.term_index): ([s["index"] for s in r.subjects], [p["index"] for p in r.predicates], r.rule)
        for r in rows
    }


GOLDEN = {
    # the window is narrow; the garden is wide
    "narrow_window": (sentence("窓/名詞/一般", "が/助詞/格助詞", "狭い/形容詞!"), 2, [0], [2]),
    "wide_garden": (sentence("庭/名詞/一般", "が/助詞/格助詞", "広い/形容詞!"), 2, [0], [2]),
    # tired of a heavy load: the search back from the verb stops at the adjective
    "heavy_load": (sentence("重い/形容詞", "荷物/名詞/一般", "に/助詞/格助詞", "疲れる/動詞!"), 3, [1], [3]),
    # a film whose sound is weak: seen from the end, only the film
    "weak_sound": (
        sentence("音/名詞/一般", "が/助詞/格助詞", "弱い/形容詞!", "映画/名詞/一般", "も/助詞/係助詞"), 2, [3], [2]),
    # predicates joined by a conjunctive particle, seen from the last verb
    "heavy_and_tired": (
        sentence("荷物/名詞/一般", "が/助詞/格助詞", "重い/形容詞", "て/助詞/接続助詞", "疲れる/動詞!"), 4, [0], [2, 4]),
    # a negative noun with a predicate after it, before it, and alone
    "noun_with_predicate": (sentence("臭い/名詞/一般!", "が/助詞/格助詞", "残る/動詞"), 0, [0], [2]),
    "noun_as_predicate": (sentence("対応/名詞/一般", "が/助詞/格助詞", "最悪/名詞/一般!"), 2, [0], [2]),
    "noun_alone": (sentence("最悪/名詞/一般!"), 0, [0], []),
    "other_class": (sentence("まま/助詞/副助詞!", "窓/名詞/一般"), 0, [], []),
    # the adjective before a noun that cannot be a subject
    "no_subject_noun": (sentence("辛い/形容詞!", "日々/名詞/副詞可能"), 0, [], [0]),
    # the adjectival noun before the noun it modifies
    "adjectival_noun": (
        [{"sentence": 1, "lemma": "嫌", "pos": "形容動詞", "sub_pos": "*", "hit": True},
         {"sentence": 1, "lemma": "だ", "surface": "な", "pos": "助動詞", "sub_pos": "*", "inflection": "体言接続"},
         {"sentence": 1, "lemma": "匂い", "pos": "名詞", "sub_pos": "一般"}], 0, [2], [0]),
    # subjects in an earlier and in a later sentence
    "earlier": (
        sentence("窓/名詞/一般", "見る/動詞") + sentence("狭い/形容詞!", number=2), 2, [0], [1, 2]),
    "later": (
        sentence("狭い/形容詞!") + sentence("狭い/形容詞", "窓/名詞/一般", "見る/動詞", number=3), 0, [2], [0, 3]),
}


@pytest.fixture(scope="module")
def golden(spark):
    return pairs(spark, {k: v[0] for k, v in GOLDEN.items()})


@pytest.mark.parametrize("name", list(GOLDEN))
def test_golden_sentences(golden, name):
    tokens, term, subjects, predicates = GOLDEN[name]
    got = golden[(name, term)]
    assert got[0] == subjects
    assert sorted(got[1]) == predicates
    assert (subjects, predicates) == tuple(map(sorted, Review(
        [{"inflection": "*", "surface": t["lemma"], **t} for t in tokens], JAPANESE_RULES).pair(term)))


def random_review(rng, rules):
    kinds = [
        ("名詞", "一般", "*"), ("名詞", "一般", "*"), ("名詞", "非自立", "*"), ("名詞", "副詞可能", "*"),
        ("動詞", "自立", "連用形"), ("動詞", "非自立", "連用形"), ("形容詞", "自立", "基本形"), ("形容詞", "自立", "基本形"),
        ("形容動詞", "*", "*"), ("助詞", "接続助詞", "*"), ("助詞", "連体化", "*"),
        ("助動詞", "*", "仮定形"), ("助動詞", "*", "体言接続"), ("記号", "一般", "*"),
    ]
    tokens, number = [], 1
    for _ in range(rng.randint(1, 16)):
        number += rng.choice([0, 0, 0, 1, 2]) if tokens else rng.choice([0, 1])
        pos, sub_pos, inflection = rng.choice(kinds)
        lemma = {
            "助詞": rng.choice(["て", "の", "が", "けど"]), "助動詞": rng.choice(["な", "ば"]),
        }.get(pos, rng.choice(["a", "b", "c", "d", "こと", "ん", "すぎる"]))
        tokens.append({
            "sentence": number, "pos": pos, "sub_pos": sub_pos, "inflection": inflection, "lemma": lemma,
            "surface": lemma, "hit": rng.random() < 0.4,
        })
    return tokens


@pytest.mark.parametrize("rules", [JAPANESE_RULES, SPACED_RULES])
def test_random_reviews_match_definition(spark, rules):
    rng = random.Random(7)
    reviews = {f"r{i}": random_review(rng, rules) for i in range(3000)}
    got = pairs(spark, reviews, rules)
    wanted = {
        (key, p): Review(tokens, rules).pair(p)
        for key, tokens in reviews.items() for p, t in enumerate(tokens) if t["hit"]
    }
    assert got.keys() == wanted.keys()
    wrong = {
        k: (got[k], w, reviews[k[0]]) for k, w in wanted.items() if got[k][0] != w[0] or sorted(got[k][1]) != sorted(w[1])
    }
    assert not wrong, next(iter(wrong.items()))
    assert {r for _, _, r in got.values()} == {
        "noun_then_predicate", "noun_as_predicate", "noun_alone", "modifier", "other", "subject_before",
        "subject_after", "earlier_sentence", "later_sentence", "no_subject",
    }


def test_one_reason_per_predicate_and_distinct(spark):
    tokens = sentence("荷物/名詞/一般", "が/助詞/格助詞", "重い/形容詞!", "て/助詞/接続助詞", "疲れる/動詞!")
    tokens[0]["entity"], tokens[2]["issue"] = "Price", "Value"
    reasons = build_reasons(extract_pairs(frame(spark, {"r": tokens}))).orderBy("predicate").collect()
    # both terms lead to the same two pairs
    assert [(r.subject, r.predicate, r.entity, r.issue_category, r.confidence) for r in reasons] == [
        (["荷物"], "疲れる", "Price", None, 0.71), (["荷物"], "重い", "Price", "Value", 0.97)]
    assert len({r.reason_id for r in reasons}) == 2


def test_incomplete_reasons_cost_confidence(spark):
    reviews = {"alone": GOLDEN["noun_alone"][0], "none": GOLDEN["other_class"][0]}
    reasons = build_reasons(extract_pairs(frame(spark, reviews))).collect()
    assert sorted((r.subject, r.predicate, r.confidence) for r in reasons) == [([], None, 0.3), (["最悪"], None, 0.3)]


def test_reason_ids_are_stable_and_random_on_request(spark):
    made = extract_pairs(frame(spark, {"r": GOLDEN["heavy_and_tired"][0]}))
    first, second = (sorted(r.reason_id for r in build_reasons(made).collect()) for _ in range(2))
    assert first == second
    assert sorted(r.reason_id for r in build_reasons(made, random_ids=True).collect()) != first


def test_both_polarities_of_one_term(spark):
    tokens = frame(spark, {"r": GOLDEN["narrow_window"][0]}).withColumn(
        "polarities", F.when(F.col("polarities").isNotNull(), F.array(F.lit("negative"), F.lit("positive"))))
    assert sorted(r.sentiment_type for r in build_reasons(extract_pairs(tokens)).collect()) == ["negative", "positive"]
