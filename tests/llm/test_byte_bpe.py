import hashlib
import random
from types import SimpleNamespace

import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.errors import PythonException

from reviewloom.llm import byte_bpe
from reviewloom.llm.queries import op11_byte_bpe
from tests.llm.helpers import corpus, table

PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def ranks():
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as file:
        return file.read()


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding(
        "own", pat_str=PATTERN, mergeable_ranks=byte_bpe.read_ranks(ranks), special_tokens={}
    )


def odd_texts(n):
    rng = random.Random(5)
    alphabet = list("ab the ing \n\t\r\x0b\x1c\x85\xa0.,'0129éñß日本語😀‍\x00") + [
        "'s", "'LL", "<|endoftext|>", "    ", "straße", " ", "՘", "Ᲊ", "\U00010d40", "²", "Ⅷ",
    ]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(40))) for _ in range(n)]
    return texts + ["", " ", "\n", "a" * 3000, " " * 300 + "x", "-" * 999, "日本" * 400, "é" * 77]


def test_every_character_is_cut_as_the_library_does(library, ranks):
    known = byte_bpe.read_ranks(ranks)
    for start in range(0, 0x110000, 0x400):
        points = [c for c in range(start, start + 0x400) if not 0xD800 <= c < 0xE000]
        text = "".join(f"a{chr(c)}1{chr(c)} {chr(c)}" for c in points)
        found = [w for part in byte_bpe.pre_tokens(text, PATTERN) for w in part]
        assert "".join(found) == text
        assert [i for w in found for i in byte_bpe.merge(w.encode(), known)] == library.encode_ordinary(text)


def test_short_and_long_words_merge_alike(ranks, monkeypatch):
    known = byte_bpe.read_ranks(ranks)
    rng = random.Random(9)
    words = ["".join(rng.choice("theingaso") for _ in range(rng.randrange(1, 60))).encode() for _ in range(800)]
    words += [b"a" * n for n in range(1, 50)]
    monkeypatch.setattr(byte_bpe, "SHORT_WORD", 1000)
    short = [byte_bpe.merge(w, known) for w in words]
    monkeypatch.setattr(byte_bpe, "SHORT_WORD", 0)
    assert short == [byte_bpe.merge(w, known) for w in words]


def test_long_texts_are_taken_in_parts(monkeypatch):
    text = " ".join(odd_texts(50))
    whole = [w for part in byte_bpe.pre_tokens(text, PATTERN) for w in part]
    monkeypatch.setattr(byte_bpe, "LONG_TEXT", 10)
    monkeypatch.setattr(byte_bpe, "MATCHES", 7)
    parts = list(byte_bpe.pre_tokens(text, PATTERN))
    assert max(map(len, parts)) == 7 and [w for p in parts for w in p] == whole


@pytest.mark.parametrize("block", [1, 200, byte_bpe.BLOCK_CHARS])
def test_round_trip_equals_the_library(spark, ranks, library, monkeypatch, block):
    texts = [*corpus(11, 30), (None, "null id"), (7, "same id"), (7, "same id")]
    texts += [(1000 + i, t) for i, t in enumerate(odd_texts(150))]
    monkeypatch.setattr(byte_bpe, "BLOCK_CHARS", block)
    rows = byte_bpe.decode(
        byte_bpe.encode(table(spark, texts, extra=True), ranks, PATTERN), ranks
    ).collect()
    got = sorted((repr(r.doc_id), r.ids, bytes(r.decoded)) for r in rows)
    want = sorted((repr(d), library.encode_ordinary(t or ""), (t or "").encode()) for d, t in texts)
    assert got == want


def test_empty_table_and_decoding_alone(spark, ranks, library):
    assert byte_bpe.encode(table(spark, []), ranks, PATTERN).count() == 0
    ids = library.encode_ordinary("some text, décodé")
    rows = [(1, ids), (2, []), (3, None)]
    df = spark.createDataFrame(rows, "key long, ids array<int>")
    got = {r.key: r.decoded for r in byte_bpe.decode(df, ranks).collect()}
    assert bytes(got[1]).decode() == "some text, décodé" and bytes(got[2]) == b"" and got[3] is None
    with pytest.raises(PythonException):
        byte_bpe.decode(spark.createDataFrame([([60_000],)], "ids array<int>"), ranks).collect()


def test_query_equals_the_library_on_the_given_table(spark, library):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = op11_byte_bpe(spark, folder).collect()
    assert len(rows) == len(texts)
    for row in rows:
        ids = library.encode_ordinary(texts[row.doc_id])
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(texts[row.doc_id].encode()).hexdigest()


def test_decoding_takes_few_rows_at_a_time(ranks):
    """A batch of long texts is never decoded whole; slices, nulls and empty arrays stay in place."""
    known = byte_bpe.read_ranks(ranks)
    texts = [None if i % 7 == 3 else b"ab \xff" * (i % 5) for i in range(byte_bpe.DECODED * 2 + 5)]
    ids = [None if t is None else byte_bpe.merge(t, known) if t else [] for t in texts]
    schema = pa.schema([("ids", pa.list_(pa.int32())), ("decoded", pa.binary())])
    batch = pa.RecordBatch.from_arrays([pa.array([[1]] + ids, pa.list_(pa.int32()))], names=["ids"]).slice(1)
    out = list(byte_bpe._decoder(schema, 0, SimpleNamespace(value=ranks))(iter([batch])))
    assert [len(b) for b in out] == [byte_bpe.DECODED, byte_bpe.DECODED, 5]
    assert [v for b in out for v in b.column(1).to_pylist()] == texts


def test_tasks_get_the_pattern_spelt_out(monkeypatch):
    spelt = byte_bpe.spelt_out(PATTERN)
    monkeypatch.setattr(byte_bpe, "_ranges", None)
    byte_bpe.spelt_out.cache_clear()
    assert list(byte_bpe.pre_tokens("ab 12é 日本", spelt)) == [["ab", " 12", "é", " 日本"]]
