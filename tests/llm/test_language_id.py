import random

import pytest
from pyspark.sql import functions as F

from reviewloom.llm import language_id as L
from tests.llm.helpers import table

WORDS = {
    "en": "the house stands near water and every child knows this small garden with green trees".split(),
    "de": "das haus steht nahe beim wasser und jedes kind kennt diesen kleinen garten mit bäumen".split(),
    "fr": "la maison se trouve près de eau et chaque enfant connaît ce petit jardin avec arbres".split(),
}


def rows(n=240):
    rng = random.Random(3)
    out = []
    for i in range(n):
        name = ("en", "de", "fr")[i % 3]
        text = " ".join(rng.choice(WORDS[name]) for _ in range(rng.choice([1, 3, 30])))
        declared = rng.choice([None, "de", "en"]) if i % 11 == 0 else name
        out.append((i, text, declared, f"{name}-host{i % 4}" if i % 10 else "mixed", 0))
    return out


def test_evidence_is_fused(spark):
    data = rows() + [(500, None, "en", None, 0), (501, "", "en", "h", 0), (502, "123 ... 456", "de", "h", 0)]
    data += [(None, "das haus und der garten", "de", None, 0), (503, "the house " * 30_000, None, None, 0)]
    docs = table(spark, data, extra=True)
    got = L.identify(docs, declared=F.col("lang"), host=F.col("source")).collect()
    assert len(got) == len(data)
    found = {r.doc_id: r for r in got}
    right = sum(found[i].language == ("en", "de", "fr")[i % 3] for i in range(240))
    assert right >= 232
    assert not any(found[i].rejected for i in range(240))
    for i in (500, 501, 502):
        assert found[i].rejected and found[i].language == "und"
    assert found[503].language == "en" and found[None].language == "de"


def test_hosts_decide_where_the_text_does_not(spark):
    data = rows()
    data += [(600, "xq", None, "fr-host1", 0), (601, "xq", None, "de-host1", 0)]
    got = L.identify(table(spark, data), declared=F.col("lang"), host=F.col("source"), confidence=0.0)
    found = {r.doc_id: r.language for r in got.collect()}
    assert (found[600], found[601]) == ("fr", "de")


def test_every_declared_language_is_modelled(spark):
    """130 languages of their own letters, some with regions; the rarest are found and kept too."""
    rng = random.Random(5)
    data = []
    for k in range(130):
        letters = [chr(0x4E00 + 20 * k + j) for j in range(20)]
        vocabulary = ["".join(rng.choice(letters) for _ in range(5)) for _ in range(8)]
        name = f"x{k:03}" + ("-gb" if k % 3 else "")
        for j in range(4 if k < 100 else 3):
            text = " ".join(rng.choice(vocabulary) for _ in range(20))
            data.append((len(data), text, name, f"h{k % 7}", 0))
    got = L.identify(table(spark, data), declared=F.col("lang"), host=F.col("source")).collect()
    found = {r.doc_id: r for r in got}
    assert len(found) == len(data)
    assert all(found[d[0]].language == d[2] and not found[d[0]].rejected for d in data)


def test_drop_keeps_rows_and_columns(spark):
    docs = table(spark, rows(60) + [(500, None, "en", None, 0), (7, "again the house", "en", "h", 0)], extra=True)
    kept = L.drop_rejected(docs, declared=F.col("lang"), host=F.col("source"))
    assert kept.columns == docs.columns and kept.count() == 61


def test_empty_tables_and_no_declarations(spark):
    assert L.drop_rejected(table(spark, []), declared=F.col("lang")).count() == 0
    got = L.identify(table(spark, [(1, "some words")])).collect()
    assert len(got) == 1


@pytest.mark.parametrize("url,host,suffix", [
    ("https://user@WWW.Example.de:80/x?y", "www.example.de", "de"), ("nothing", "", ""), (None, "", ""),
])
def test_addresses(spark, url, host, suffix):
    df = spark.createDataFrame([(url,)], "url string").select(L.host_of(F.col("url")).alias("h"))
    row = df.select("h", L.suffix_of(F.col("h")).alias("s")).first()
    assert (row.h, row.s) == (host, suffix)


def test_declared_in_markup(spark):
    data = [('<html LANG="pt-BR">',), ("<!x><html dir=ltr lang='de'>",), ("<html>",), (None,)]
    df = spark.createDataFrame(data, "html string").select(L.declared_in(F.col("html")).alias("d"))
    assert [r.d for r in df.collect()] == ["pt", "de", None, None]
