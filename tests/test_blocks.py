"""Operators over whole partitions of token rows: what Spark plans for them, and rows in any order."""

import random

import pyarrow as pa
from pyspark.sql import functions as F

from reviewloom.functions import blocks
from reviewloom.operators import compounds, extract
from reviewloom.operators.compounds import fold_reviews
from reviewloom.operators.extract import SPACED_RULES, review_pairs
from reviewloom.operators.reasons import build_reasons
from tests.test_extract import frame, random_review
from tests.test_long_reviews import MORPHEMES, RUN, by_definition, morphemes, seconds, text_of


def morpheme_rows(reviews):
    for key, (ms, text) in reviews.items():
        for i, m in enumerate(ms):
            yield (key, i, *m, "run", f"id_{key}", text if i == 0 else None)


def test_words_are_folded_without_arrays_of_reviews(spark):
    rows = spark.createDataFrame(morpheme_rows({"r": (morphemes(random.Random(1), 5), "ab")}), f"{MORPHEMES}, {RUN}")
    plan = fold_reviews(rows)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "collect_list" not in plan and "aggregate(" not in plan


def test_morphemes_in_any_order_and_partition_fold_as_defined(spark):
    rng = random.Random(21)
    reviews = {}
    for i in range(200):
        ms = morphemes(rng, rng.choice([1, 2, 5, 30]))
        reviews[f"r{i}"] = (ms, text_of(rng, ms))
    rows = list(morpheme_rows(reviews))
    rng.shuffle(rows)
    found = {key: [] for key in reviews}
    for w in fold_reviews(spark.createDataFrame(rows, f"{MORPHEMES}, {RUN}").repartition(5)).orderBy("place").collect():
        found[w.row_id].append((
            w.sentence, w.place, w.surface, w.pos, w.sub_pos, w.inflection, w.lemma, w.start_offset, w.end_offset))
        assert (w.run_id, w.review_id) == ("run", f"id_{w.row_id}")
    assert found == {key: by_definition(*r) for key, r in reviews.items()}


def test_a_word_that_no_text_holds_is_searched_once(spark, tmp_path):
    spent = {}
    for n in (20_000, 80_000):
        ms = [("zz", "記号", "一般", "*", "zz")] * n
        spark.createDataFrame(morpheme_rows({"r": (ms, "ab " * n)}), f"{MORPHEMES}, {RUN}").write.parquet(f"{tmp_path}/{n}")
        spent[n] = seconds(lambda: fold_reviews(spark.read.parquet(f"{tmp_path}/{n}").coalesce(1)), spark)
    assert spent[80_000] < 8 * max(spent[20_000], 0.2), spent
    last = fold_reviews(spark.read.parquet(f"{tmp_path}/80000")).agg(F.max("end_offset")).first()
    assert last[0] == 2 * 80_000 - 1


def test_pairs_are_formed_without_arrays_of_words(spark):
    tokens = frame(spark, {"r": random_review(random.Random(2), SPACED_RULES)}).repartition(3, "row_id")
    plan = review_pairs(tokens, SPACED_RULES)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "collect_list" not in plan and "Sort" not in plan
    assert plan.count("Exchange") == 1  # of the rows as they came


def test_tokens_in_any_order_and_partition_pair_alike(spark):
    rng = random.Random(22)
    tokens = frame(spark, {f"r{i}": random_review(rng, SPACED_RULES) for i in range(300)})
    wanted, found = (
        {r.row_id: r for r in review_pairs(rows, SPACED_RULES).collect()}
        for rows in (tokens, tokens.orderBy(F.xxhash64("row_id", "place")).repartition(5)))
    assert found == wanted and len(wanted) > 200


def given_to(build, monkeypatch):
    """The rows of one partition as an operator hands them to Python."""
    held = []
    with monkeypatch.context() as m:
        m.setattr(blocks, "together", lambda rows, key: held.append(rows) or rows)
        build()
    return held[0].toArrow()


def test_results_do_not_depend_on_batches_blocks_and_slices_of_walks(spark, monkeypatch):
    rng = random.Random(23)
    tokens = frame(spark, {f"r{i:03}": random_review(rng, SPACED_RULES) for i in range(150)})
    words = [(f"r{i:03}", ms, text_of(rng, ms)) for i in range(100) for ms in [morphemes(rng, rng.choice([1, 3, 20]))]]
    rows = spark.createDataFrame(morpheme_rows({key: (ms, text) for key, ms, text in words}), f"{MORPHEMES}, {RUN}")
    for given, run in (
        (given_to(lambda: review_pairs(tokens, SPACED_RULES), monkeypatch), extract._pairs_of),
        (given_to(lambda: fold_reviews(rows), monkeypatch), compounds._fold),
    ):
        wanted = pa.Table.from_batches(run(iter(given.combine_chunks().to_batches())))
        with monkeypatch.context() as m:
            for owner, name, value in ((blocks, "BLOCK_TOKENS", 30), (blocks, "BATCH_ROWS", 4), (extract, "WALKED", 3)):
                m.setattr(owner, name, value)
            found = pa.Table.from_batches(run(iter(given.combine_chunks().to_batches(max_chunksize=7))))
        assert found.to_pylist() == wanted.to_pylist() and wanted.num_rows > 90
    assert not list(extract._pairs_of(iter([]))) and not list(compounds._fold(iter([])))


def test_reviews_of_very_many_subjects_get_several_rows_with_the_same_reasons(spark, monkeypatch):
    rng = random.Random(24)
    reviews = {f"r{i:03}": [{**t, "sentence": 1} for _ in range(4) for t in random_review(rng, SPACED_RULES)] for i in range(60)}
    given = given_to(lambda: review_pairs(frame(spark, reviews), SPACED_RULES), monkeypatch)
    wanted = pa.Table.from_batches(extract._pairs_of(iter(given.to_batches())))
    monkeypatch.setattr(extract, "ROW_SUBJECTS", 40)
    found = pa.Table.from_batches(extract._pairs_of(iter(given.to_batches())))
    assert found.num_rows > 1.5 * wanted.num_rows and len(set(found["row_id"].to_pylist())) == wanted.num_rows
    assert max(len(p) for p in found["pairs"].to_pylist()) < max(len(p) for p in wanted["pairs"].to_pylist())
    one, other = (sorted(map(repr, build_reasons(spark.createDataFrame(t)).collect())) for t in (wanted, found))
    assert one == other and len(one) > 500
