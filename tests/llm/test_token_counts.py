import random

import public_tokenizers
import pytest
import sentencepiece

from reviewloom.llm.token_counts import Merges, read_merges, token_counts
from tests.llm.helpers import corpus, table

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def model():
    with open(PATH, "rb") as file:
        return file.read()


def test_counts_equal_the_library(model):
    merges, library = read_merges(model), sentencepiece.SentencePieceProcessor(model_file=PATH)
    rng = random.Random(3)
    alphabet = list("ab the ing ▁\n\t\r.,0129éñß日本語😀‍\x00") + ["<s>", "</s>", "<unk>", "<0x41>", "    ", "straße"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(40))) for _ in range(3000)]
    texts += ["", " ", "\n", "a" * 5000, "▁" * 40, "no spaces" * 400]
    assert [merges.count(t) for t in texts] == [len(x) for x in library.encode(texts)]


def test_remembered_words_stay_bounded(model, monkeypatch):
    from reviewloom.llm import token_counts as module

    monkeypatch.setattr(module, "REMEMBERED", 10)
    merges = read_merges(model)
    for i in range(50):
        merges.count(" ".join(f"w{i}x{k}" for k in range(5)))
    assert len(merges.known) <= 16


def test_equal_ranks_merge_leftmost_first():
    merges = Merges({"aa": 1.0, "aaa": 1.0, "a": 9.0}, byte_fallback=False, dummy_prefix=False)
    assert merges.count_part("aaa") == 1 and merges.count_part("aaaa") == 2
    assert Merges({"ab": 2.0, "bc": 1.0}, False, False).count_part("abc") == 2


def test_rows(spark, model):
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    rows = corpus(11, 40) + [(None, "null id")]
    got = token_counts(table(spark, rows, extra=True), model, limit=100).collect()
    want = [(d, len((t or "").encode()), n := len(library.encode(t or "")), n > 100) for d, t in rows]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert token_counts(table(spark, []), model).count() == 0
