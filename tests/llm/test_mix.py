import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from reviewloom.llm.mix import Mix, mix, permuted
from tests.llm.helpers import corpus, table


def levels(sizes, weights=(5, 2, 1), share=1.5, cap=2):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    target, open_, left = {}, set(names), share * sum(sizes.values())
    while True:
        level = left / sum(weight[s] for s in open_) if open_ else 0
        over = {s for s in open_ if weight[s] * level > cap * sizes[s]}
        if not over:
            return target | {s: weight[s] * level for s in open_}
        for s in over:
            target[s] = cap * sizes[s]
            left -= target[s]
        open_ -= over


def cases():
    rng = random.Random(4)
    sources = ["a", "b", "é", None, "hot", "hot", "hot", "z"]
    rows = [(d, t, "en", rng.choice(sources), 0) for d, t in corpus(9, 300)]
    return rows + [(None, "null id here", "en", "a", 0), (900, None, "en", "empty source", 0), (900, None, "en", "empty source", 0)]


def test_targets_and_bounds(spark):
    rows = cases()
    got = mix(table(spark, rows, extra=True)).collect()
    assert len(got) == len(rows)
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    for r in got:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
        assert 0 <= r.taken <= 2 * r.size
    assert {(r[0], r[3]): len((r[1] or "").split()) for r in rows} == {(r.doc_id, r.source): r.size for r in got}
    want = levels(sizes)
    for s in sizes:
        assert target[s] == pytest.approx(want[s], rel=1e-12)
        assert abs(taken[s] - want[s]) <= max(64, 0.01 * want[s])


def test_reruns_agree_on_other_partitions(spark):
    rows = cases()
    first = mix(table(spark, rows)).collect()
    again = mix(table(spark, rows[::-1]).repartition(7)).collect()
    assert sorted(map(repr, first)) == sorted(map(repr, again))


def test_slots_fill_shards_and_blocks(spark):
    made = Mix(table(spark, cases()), block_words=16, shard_slots=100)
    slots = made.slots.collect()
    quota = {r.no: (r.quota, r.n_blocks) for r in made.blocks.collect()}
    times = defaultdict(lambda: defaultdict(int))
    shards = defaultdict(int)
    for s in slots:
        times[s.no][s.block] += 1
        shards[s.shard] += 1
    for no, (q, n) in quota.items():
        assert sum(times[no].values()) == q
        assert all(0 <= b < n for b in times[no])
        assert not q or max(times[no].values()) - (min(times[no].values()) if len(times[no]) == n else 0) <= 1
    assert sorted(shards.values())[1:] == [100] * (len(shards) - 1)


@pytest.mark.parametrize("n", [1, 2, 3, 17, 64, 1000])
def test_permutation(spark, n):
    df = spark.range(n).select(permuted(F.col("id"), F.lit(n).cast("long"), F.lit(5).cast("long")).alias("p"))
    assert sorted(r.p for r in df.collect()) == list(range(n))


def test_empty_tables(spark):
    assert mix(table(spark, [])).count() == 0
    assert [r.taken for r in mix(table(spark, [(1, None), (2, " ")])).collect()] == [0, 0]
