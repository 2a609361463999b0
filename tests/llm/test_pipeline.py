import corpus_pipeline
from __spark_entry__ import queries
from reviewloom.llm.common import SPACES
from tests.llm import test_decontaminate, test_jaccard_join, test_line_dedup
from tests.llm.helpers import table, words


def test_stages_equal_their_definitions(spark, tmp_path):
    import random

    rng = random.Random(12)
    vocabulary = 300
    items = [(i, " ".join(words(rng, 12, vocabulary))) for i in range(5)]
    rows = []
    for i in range(80):
        lines = [" ".join(words(rng, rng.choice([4, 12, 40]), vocabulary)) for _ in range(rng.randrange(1, 4))]
        if i % 9 == 0:
            lines.append("the line that many documents hold")
        if i % 13 == 0:
            lines.append("so " + items[i % 5][1])
        if rows and i % 4 == 0:
            own = rng.choice(rows)[1].replace("\n", " ").split(" ")
            own[rng.randrange(len(own))] = "changed"
            lines = [" ".join(own)]
        rows.append((i, "\n".join(lines), "en", f"s{i % 3}", 0))
    rows += [(90, None, "en", "s0", 0), (91, "...", "en", None, 0), (92, rows[5][1], "en", "s1", 0)]
    table(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    left = [(d, t) for d, t, *_ in rows if any(c.isalpha() for c in t or "")]
    left = test_line_dedup.expected(left)
    classes = test_jaccard_join.expected(left, 5, 80)
    stays = {d for d, _, c in classes if c == d}
    left = [(d, t) for d, t in left if d in stays]
    hits = test_decontaminate.expected(left, items)
    left = [(d, t) for d, t in left if not hits[d][1]]
    sizes = {d: len("".join(" " if c in SPACES else c for c in t).split()) for d, t in left}

    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id: r.size for r in got} == sizes
    assert len(sizes) < len(rows) - 10
    assert all(r.taken <= 2 * r.size for r in got)
    total = sum(sizes.values())
    assert abs(sum(r.taken for r in got) - 1.5 * total) < 0.05 * total


def test_stages_are_the_named_ones():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "jaccard_join", "decontaminate", "mix"]
    assert {f"op{n}" for n in range(1, 11)} == {q.split("_")[0] for q in queries() if q.startswith("op")}
    assert "pipeline" in queries()
