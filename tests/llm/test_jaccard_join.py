import random
from collections import defaultdict

import pytest

from reviewloom.llm import jaccard_join as J
from reviewloom.llm.components import components, merged
from tests.llm.helpers import corpus, table


def shingles(text, size):
    w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for space in "\t\n\x0b\x0c\r":
        w = w.replace(space, " ")
    w = [x for x in w.split(" ") if x]
    return {tuple(w[i : i + size]) for i in range(max(len(w) - size + 1, 1 if w else 0))}


def expected(rows, size, num):
    sets = [shingles(t, size) for _, t in rows]
    least = {d: d for d, _ in rows}

    def root(d):
        while least[d] != d:
            d = least[d]
        return d

    for i, (a, _) in enumerate(rows):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= num * (len(sets[i]) + len(sets[j]) - both):
                x, y = sorted((root(a), root(rows[j][0])))
                least[y] = x
    return sorted((d, len(s), root(d)) for (d, _), s in zip(rows, sets))


def near_group(n):
    """One base with one or two words changed in each copy: many pairs link, many do not."""
    rng = random.Random(8)
    base = [f"b{i}" for i in range(90)]
    rows = []
    for i in range(n):
        own = list(base)
        for _ in range(rng.randrange(1, 4)):
            own[rng.randrange(90)] = f"x{rng.randrange(40)}"
        rows.append((5000 + i, " ".join(own)))
    return rows


@pytest.mark.parametrize("size,num", [(3, 90), (5, 80)])
def test_matches_its_definition(spark, size, num):
    rows = corpus(21, 120) + near_group(60)
    got = J.near_components(table(spark, rows, extra=True), size=size, num=num, den=100)
    found = sorted((r.doc_id, r.n_shingles, r.component_id) for r in got.collect())
    want = expected(rows, size, num)
    assert found == want
    assert len({c for _, _, c in want}) < len({d for d, _, _ in want}) - 20


def test_one_deletion_neighbourhoods_find_all(spark, monkeypatch):
    """Candidates so dear that segments are long and carry neighbourhoods."""
    monkeypatch.setattr(J, "CANDIDATE", 1e6)
    rows = near_group(60)
    got = J.near_components(table(spark, rows), size=3, num=90, den=100)
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()) == expected(rows, 3, 90)


def test_signatures_meet_within_the_distance():
    """Any two sets that are near enough share a signature, one of them of a whole segment,
    whether empty signatures are left out or (without spare) given."""
    import pyarrow as pa

    rng = random.Random(1)
    threshold = J.Threshold(90, 100)
    for docs, without in ((10.0, False), (1e9, False), (1e9, True)):
        plan = {}
        for b in range(30):
            apart = threshold.apart(J.band(b)[1])
            if apart:
                plan[b] = J.allocate(sum(J.band(b)) / 2, J.band(b)[0], apart, docs, 0.01)
                assert plan[b].whole + 2 * plan[b].near == apart + 1 + plan[b].spare
        if without:
            plan = {b: J.Allocation(a.whole - a.spare, a.near, 0) for b, a in plan.items()}
            plan = {b: a for b, a in plan.items() if a.whole + 2 * a.near > threshold.apart(J.band(b)[1])}
        run, _ = J._signature_rows(pa.int64(), 1, threshold, plan)
        for _ in range(60):
            n = rng.randrange(20, 400)
            a = [f"w{i}" for i in range(n)]
            b = list(a)
            for _ in range(rng.randrange(1, n // 20 + 1)):
                b[rng.randrange(len(b))] = f"z{rng.randrange(10**6)}"
            b = b[: n - rng.randrange(0, n // 40 + 1)]
            x, y = set(a), set(b)
            if 100 * len(x & y) < 90 * len(x | y) or x == y:
                continue
            batch = pa.RecordBatch.from_pydict({"id": [1, 2], "text": [" ".join(a), " ".join(b)]})
            met = defaultdict(set)
            for out in run(iter([batch])):
                for sig, doc, full in zip(*(out.column(i).to_pylist() for i in (0, 1, 3))):
                    met[sig].add((doc, full))
            assert any({d for d, _ in m} == {1, 2} and any(f for _, f in m) for m in met.values())


def test_differences_from_pivots_lose_no_link(spark, monkeypatch):
    """Signatures of more than two rows always go by pivots, and their members by differences."""
    monkeypatch.setattr(J, "SMALL", 2)
    monkeypatch.setattr(J, "PLACED", 2)
    rows = near_group(45)
    got = J.near_components(table(spark, rows), size=3, num=90, den=100)
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()) == expected(rows, 3, 90)


@pytest.mark.parametrize("num", [50, 80, 90])
def test_linked_sets_share_an_early_difference(num):
    """Of two linked sets that are not both linked with a pivot and both near, the first difference
    in common is among the first ``prefix`` of both; near sets are told from far ones on both sides."""
    rng = random.Random(num)
    threshold = J.Threshold(num, 100)

    def linked(x, y):
        return threshold.close(len(x ^ y), len(x) + len(y))

    met = 0
    for _ in range(20_000):
        n = rng.randrange(5, 60)
        sets = []
        for _ in range(3):
            keep = rng.uniform(0.6, 1)
            own = {v for v in range(n) if rng.random() < keep}
            sets.append(own | {rng.randrange(100, 112) for _ in range(rng.randrange(4))})
        b, x, y = sets
        if not (x and y and b) or not linked(x, y) or (linked(x, b) and linked(y, b)):
            continue
        room = [threshold.radius(len(b)) - len(s ^ b) for s in (x, y)]
        both_near = min(room) >= 0
        assert both_near or all(r < threshold.apart(len(s)) for r, s in zip(room, (x, y)))
        if both_near and x != b and y != b:
            met += 1
            first = min((x ^ b) & (y ^ b))
            for s in (x, y):
                place = sorted(s ^ b).index(first) + 1
                assert place <= threshold.prefix(len(s ^ b), len(s), len(b), linked(s, b))
    assert met > 50


def test_strangers_of_one_template_make_few_pairs(spark, monkeypatch):
    """Texts of one template with nine words of their own each: none link, and the pairs compared
    grow with the texts, not with their square."""
    made = []
    verify = J.NearCopies._verify
    monkeypatch.setattr(
        J.NearCopies, "_verify", lambda self, pairs, texts: made.append(pairs.count()) or verify(self, pairs, texts)
    )
    rng = random.Random(3)

    def compared(n):
        rows = []
        for i in range(n):
            words = [f"t{k}" for k in range(110)]
            for k in rng.sample(range(110), 9):
                words[k] = f"own{i}x{k}"
            rows.append((i, " ".join(words)))
        made.clear()
        got = J.near_components(table(spark, rows), size=3, num=90, den=100).collect()
        assert all(r.component_id == r.doc_id for r in got)
        return sum(made)

    few = compared(150)
    assert compared(600) <= 6 * max(few, 150)


def test_a_prefix_is_no_longer_than_linked_sets_differ():
    threshold = J.Threshold(80, 100)
    assert threshold.prefix(100, 200, 200, False) == threshold.apart(200) + 1 == 51


def test_signatures_with_the_same_members_count_once(spark):
    rows = [(sig, doc, 0, None, None) for sig in (1, 2, 3) for doc in (10, 11)]
    rows += [(4, 10, 0, None, None), (4, 12, 0, None, None), (5, 10, 0, None, None)]
    rows += [(sig, doc, 0, 7, place) for sig, place in ((6, 3), (8, 2)) for doc in (10, 11)]
    members = spark.createDataFrame(rows, "sig long, id long, text_key long, origin long, place int")
    held = J._several(members, None).groupBy("sig").count().collect()
    assert sorted(map(tuple, held)) == [(1, 2), (4, 2), (8, 2)]


def test_long_strangers_of_one_template_end_by_sketches(spark, monkeypatch):
    """Sets too large for narrow sketches, in signatures of more rows than may end without any."""
    monkeypatch.setattr(J, "SMALL", 4)
    rng = random.Random(4)
    base = [f"b{i}" for i in range(500)]
    rows = [(i, " ".join(base + [f"x{i}_{k}" for k in range(240)])) for i in range(40)]
    for i, text in rows[:6]:
        own = text.split()
        own[rng.randrange(600, 740)] = "other"
        rows.append((1000 + i, " ".join(own)))
    landed = []
    plain = J.land

    def noting(df, name):
        landed.append((name, plain(df, name)))
        return landed[-1][1]

    monkeypatch.setattr(J, "land", noting)
    got = J.near_components(table(spark, rows), size=5, num=80, den=100)
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()) == expected(rows, 5, 80)
    rounds = [df.count() for name, df in landed if name == "ranked"]
    assert len(rounds) <= 2 and max(rounds) == rounds[0]


def test_wide_sketches_fold_to_narrow_ones(spark):
    rows = [(i, " ".join(f"w{i}_{k}" for k in range(n))) for i, n in enumerate((3, 700, 2000, 9000))]
    sets = J.NearCopies(table(spark, rows), size=1).sets
    size = 1024 // 64
    folded = sets.orderBy("id").select("n", "sketch", "wide", J._fold_to(J.F.col("wide"), J.F.lit(size)).alias("f"))
    for r in folded.collect():
        bits = J.Threshold(80, 100).sketch_bits(r.n)
        assert r.wide is None if bits == 1024 else (len(r.wide) * 64 == bits and r.f == r.sketch)
        assert bits == 1024 or 1.7 * r.n < bits < 4 * r.n


def test_drop_keeps_one_of_each_group(spark):
    rows = near_group(30) + [(1, "a b c"), (1, "a b c"), (2, "a b c"), (3, None), (4, ""), (None, "a b c")]
    docs = table(spark, rows, extra=True)
    kept = J.drop_near_copies(docs)
    assert kept.columns == docs.columns
    ids = sorted(str(r.doc_id) for r in kept.collect())
    want = {c for _, _, c in expected([r for r in rows if r[0]], 5, 80)}
    assert sorted({i for i in ids if i != "None"}) == sorted(map(str, want))
    assert ids.count("1") == 2 and ids.count("None") == 1


def test_empty_table(spark):
    assert J.near_components(table(spark, [])).count() == 0
    got = J.near_components(table(spark, [(1, None), (2, " ")])).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == [(1, 0, 1), (2, 0, 2)]


def test_components_of_chains_stars_and_rings(spark):
    rng = random.Random(6)
    pairs = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 50)]
    pairs += [(2000 + i, 2000 + (i * 7 + 3) % 97) for i in range(97)] + [(5000, 5000)]
    pairs = [(a, b) for a, b in pairs if a != b or a == 5000]
    rng.shuffle(pairs)
    least = {}

    def root(x):
        least.setdefault(x, x)
        while least[x] != x:
            x = least[x]
        return x

    for a, b in pairs:
        x, y = sorted((root(a), root(b)))
        least[y] = x
    want = {x: root(x) for x in list(least) if x != 5000}
    links = spark.createDataFrame(pairs, "a long, b long")
    assert {r.id: r.component for r in components(links).collect()} == want
    half = merged(None, spark.createDataFrame(pairs[:200], "a long, b long"))
    both = merged(half, spark.createDataFrame(pairs[200:], "a long, b long"))
    assert {r.id: r.component for r in both.collect() if r.id != 5000} == want
