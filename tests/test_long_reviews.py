"""Extraction and compounds on long reviews: same results as short ones, time in proportion to length."""

import random
import time

import pytest
from pyspark.sql import functions as F

from reviewloom.operators.compounds import fold_reviews
from reviewloom.operators.extract import SPACED_RULES, extract_pairs
from tests.test_compounds import COLUMNS as MORPHEMES
from tests.test_extract import frame, pairs, random_review
from tests.walks import Review

RUN = "run_id string, review_id string, review_text string"
CLASSES = [
    ("名詞", "一般", "*", None), ("名詞", "サ変接続", "*", None), ("動詞", "自立", "未然形", None),
    ("動詞", "自立", "連用形", None), ("動詞", "自立", "連用タ接続", None), ("形容詞", "自立", "連用テ接続", None),
    ("動詞", "接尾", "未然形", "られる"), ("助動詞", "*", "連用形", "ない"), ("助動詞", "*", "基本形", "たい"),
    ("動詞", "非自立", "連用形", "てる"), ("助詞", "接続助詞", "*", "て"), ("動詞", "自立", "連用形", "する"),
    ("動詞", "サ変接続", "基本形", "できる"), ("助詞", "格助詞", "*", "を"), ("動詞", "非自立", "連用形", "いる"),
    ("記号", "一般", "*", None), ("助詞", "サ変接続", "*", "を"),
]


def morphemes(rng, n, delimiters=0.1):
    out = []
    for _ in range(n):
        if rng.random() < delimiters:
            out.append(("|", "記号", "一般", "*", "|"))
            continue
        pos, sub_pos, inflection, lemma = rng.choice(CLASSES)
        surface = rng.choice(["a", "B", "ab", "bca", "cc", "é"])
        out.append((surface, pos, sub_pos, inflection, lemma or surface))
    return out


def text_of(rng, ms):
    """The surfaces in order, some left out and other letters between."""
    return "".join(rng.choice(["", " ", "x", "a"]) + s for s, *_ in ms if s != "|" and rng.random() < 0.95)


def by_definition(ms, text):
    """Words one morpheme after the other, each looking at the last two words."""
    text, cursor, words = text.lower(), 0, []
    for surface, pos, sub_pos, inflection, lemma in ms:
        w = words[-1] if words else None
        v = words[-2] if len(words) > 1 else None
        merged = None
        if w and pos == "動詞" and sub_pos == "接尾" and lemma in ("れる", "られる", "せる", "させる"):
            if w["pos"] == "動詞" and w["inflection"] in ("未然形", "未然レル接続"):
                merged = {"lemma": w["surface"] + lemma, "inflection": inflection}
        elif w and pos == "助動詞" and lemma in ("ない", "ぬ", "へん", "たい"):
            if w["pos"] in ("動詞", "形容詞") and w["inflection"] in ("未然形", "連用テ接続", "連用形"):
                desire = lemma == "たい"
                merged = {"lemma": w["surface"] + ("たい" if desire else "ない"), "inflection": "希望形" if desire else "否定形"}
        elif w and pos == "動詞" and sub_pos == "非自立" and lemma in ("てる", "いる"):
            if w["pos"] == "動詞" and w["inflection"] in ("連用形", "連用形+接続助詞", "連用タ接続"):
                merged = {"inflection": inflection}
        elif w and pos == "助詞" and sub_pos == "接続助詞" and lemma == "て":
            if w["pos"] == "動詞" and w["inflection"] in ("連用形", "連用タ接続"):
                merged = {"inflection": w["inflection"] + "+接続助詞"}
        elif w and pos == "動詞" and lemma in ("する", "できる", "出来る"):
            if w["sub_pos"] == "サ変接続":
                merged = {"pos": "動詞", "lemma": w["surface"] + lemma, "inflection": inflection}
            elif v and w["pos"] == "助詞" and v["sub_pos"] == "サ変接続":
                words[-2:] = [{
                    **v, "surface": v["surface"] + surface, "pos": "動詞", "lemma": v["lemma"] + lemma,
                    "inflection": inflection, "end": v["end"] + len(w["surface"]) + len(surface)}]
                continue
        if merged:
            words[-1] = {**w, **merged, "surface": w["surface"] + surface, "end": w["end"] + len(surface)}
            continue
        at = text.find(surface.lower(), cursor)
        start = at if at >= 0 else (w["end"] + 1 if w else 0)
        words.append({
            "surface": surface, "pos": pos, "sub_pos": sub_pos, "inflection": inflection, "lemma": lemma,
            "start": start, "end": start + len(surface) - 1})
        cursor = start + len(surface)
    sentence, out = 1, []
    for place, w in enumerate(words):
        if w["surface"] == "|":
            sentence += 1
        else:
            out.append((sentence, place, w["surface"], w["pos"], w["sub_pos"], w["inflection"], w["lemma"], w["start"], w["end"]))
    return out


def folded(spark, reviews, own_text=True):
    rows, texts = [], []
    for key, (ms, text) in reviews.items():
        texts.append(("run", key, f"id_{key}", text))
        for i, m in enumerate(ms):
            rows.append((key, i, *m, "run", f"id_{key}", text if i == 0 else None))
    df = spark.createDataFrame(rows, f"{MORPHEMES}, {RUN}")
    given = None if own_text else spark.createDataFrame(texts, "run_id string, row_id string, review_id string, review_text string")
    out = {key: [] for key in reviews}
    tags = "surface pos sub_pos inflection lemma start_offset end_offset".split()
    for r in fold_reviews(df if own_text else df.drop("run_id", "review_id", "review_text"), given).collect():
        out[r.row_id].append((r.sentence, r.place, *[r[t] for t in tags]))
    return {key: sorted(words, key=lambda w: w[1]) for key, words in out.items()}


@pytest.mark.parametrize("own_text", [True, False])
def test_random_morphemes_fold_as_defined(spark, own_text):
    rng = random.Random(12)
    reviews = {}
    for i in range(600):
        ms = morphemes(rng, rng.choice([1, 2, 3, 5, 8, 13, 40]))
        reviews[f"r{i}"] = (ms, text_of(rng, ms))
    ms = morphemes(rng, 1500)
    reviews["long"] = (ms, text_of(rng, ms))
    wanted = {key: by_definition(*r) for key, r in reviews.items()}
    got = folded(spark, reviews, own_text)
    wrong = [(reviews[k], got[k], wanted[k]) for k in reviews if got[k] != wanted[k]]
    assert not wrong, wrong[0]


def test_one_shuffle_when_morphemes_bring_the_text(spark):
    rows = [("r", 0, "a", "名詞", "一般", "*", "a", "run", "id", "a")]
    df = spark.createDataFrame(rows, f"{MORPHEMES}, {RUN}").repartition(3, "row_id")
    plan = fold_reviews(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan


def long_review(rng, n):
    tokens = []
    while len(tokens) < n:
        tokens += [{**t, "sentence": t["sentence"] + (tokens[-1]["sentence"] if tokens else 0)} for t in random_review(rng, SPACED_RULES)]
    return tokens[:n]


def test_long_reviews_give_what_walks_give(spark):
    rng = random.Random(31)
    reviews = {"long": long_review(rng, 700), "no nouns": [t for t in long_review(rng, 300) if t["pos"] != "名詞"]}
    got = pairs(spark, reviews, SPACED_RULES)
    for key, tokens in reviews.items():
        review = Review(tokens, SPACED_RULES)
        for p, t in enumerate(tokens):
            if t["hit"]:
                wanted = review.pair(p)
                assert (got[key, p][0], sorted(got[key, p][1])) == (wanted[0], sorted(wanted[1]))


def seconds(build, spark):
    """The least of three runs, after one that compiles."""
    def run():
        start = time.perf_counter()
        build().agg(F.count("*"), F.max(F.length(F.to_json(F.struct("*"))))).collect()
        return time.perf_counter() - start

    run()
    return min(run() for _ in range(3))


def test_time_grows_with_length(spark, tmp_path):
    rng = random.Random(8)
    spent = {}
    for n in (5_000, 20_000):
        frame(spark, {"r": long_review(rng, n)}).write.parquet(f"{tmp_path}/tokens{n}")
        ms = morphemes(rng, n)
        text = text_of(rng, ms)
        rows = [("r", i, *m, "run", "id", text if i == 0 else None) for i, m in enumerate(ms)]
        spark.createDataFrame(rows, f"{MORPHEMES}, {RUN}").write.parquet(f"{tmp_path}/morphemes{n}")
        tokens, words = (spark.read.parquet(f"{tmp_path}/{k}{n}").coalesce(1) for k in ("tokens", "morphemes"))
        spent[n] = (
            seconds(lambda: extract_pairs(tokens, SPACED_RULES), spark), seconds(lambda: fold_reviews(words), spark))
    for short, long in zip(spent[5_000], spent[20_000]):
        assert long < 8 * max(short, 0.2), spent
    print(spent)
