import random
import unicodedata
import uuid

import pytest
from pyspark.sql import functions as F

from reviewloom.functions import ids, text
from reviewloom.functions.timestamps import posted_at_iso

# each mark alone, each run below and at the length from which it ends a sentence
MARKS = [*"!?。…()#", " ", "\t", "\n", "\u3000", "\u200a", "😴", "🤓", "☔", "💦"]
RUNS = [("、", 2), (".", 3), ("・", 3), ("w", 4)]
NORMALISED = (
    [(f"朝{mark}昼", "朝|昼") for mark in MARKS]
    + [(f"山{c * (n - 1)}川", f"山{c * (n - 1)}川") for c, n in RUNS]
    + [(f"山{c * (n + k)}川", "山|川") for c, n in RUNS for k in (0, 1, 5)]
    + [
        ("雨!?。 😴晴", "雨|晴"),
        ("!晴", "|晴"),
        ("Quiet GARDEN", "quiet|garden"),
        ("ＸＹ７", "xy7"),
        ("③ｶﾞﾗｽ", "3ガラス"),
        ("㍍", "メートル"),
        ("コ―ヒ─", "コーヒー"),
        ("眠〰い～", "眠い"),
        ("駅‐前", "駅-前"),
        ("‘右’", "‘右'"),
    ]
)
# compatibility forms with their folded forms, by the order of their blocks
KANA = "アイウエオカキクケコサシスセソタチツテトナニヌネノハヒフヘホマミムメモヤユヨラリルレロワン"
FORMS = (
    [(chr(0xFF71 + i), c) for i, c in enumerate(KANA)]
    + [(chr(0x2460 + i), str(i + 1)) for i in range(20)]
    + [(chr(0xFF01 + i), chr(0x21 + i)) for i in range(94)]
    + [("ﬀ", "ff"), ("ﬁ", "fi"), ("ﬂ", "fl"), ("ﬃ", "ffi"), ("ﬄ", "ffl"), ("ﬆ", "st"), ("ﾊﾟﾋﾞ", "パビ"), ("Å", "Å")]
)


def column(spark, values, expression, name="c string"):
    rows = spark.createDataFrame([(v,) for v in values], name)
    return [r.out for r in rows.select(expression(F.col("c")).alias("out")).collect()]


def test_normalise(spark):
    assert column(spark, [a for a, _ in NORMALISED], text.normalise) == [b for _, b in NORMALISED]


def test_normalise_twice_changes_nothing(spark):
    values = [a for a, _ in NORMALISED] + ["庭が　広い!! ﾄﾞｱ②は…重い、、"]
    once = column(spark, values, text.normalise)
    assert column(spark, once, text.normalise) == once


def test_fold_first_splits_at_fullwidth_marks(spark):
    profile = text.TextProfile(fold_first=True)
    assert column(spark, ["海！空？"], lambda c: text.normalise(c, profile)) == ["海|空|"]
    assert column(spark, ["海！空？"], text.normalise) == ["海!空?"]


def test_nfkc(spark):
    assert column(spark, [a for a, _ in FORMS], text.nfkc) == [b for _, b in FORMS]


def test_texts_that_nfkc_may_change_are_told_by_few_ranges(spark):
    assert text._steady().count("{") < 60
    rows = spark.createDataFrame([(i, f"{'a' * (i % 3)}{chr(i)}") for i in range(1, 0x400)], "i int, t string")
    told = rows.select("t", F.col("t").rlike(text._steady()).alias("steady")).collect()
    for row in told:
        assert row.steady == all(ord(c) < 0x300 and unicodedata.normalize("NFKC", c) == c for c in row.t)


def test_native_fold_agrees_with_nfkc_on_ascii_forms(spark):
    values = ["ＡＢＣ　１２３！？（）", "abc 123"]
    assert column(spark, values, text.fold_width) == column(spark, values, text.nfkc)


def test_strip_trims_what_the_pattern_matches(spark):
    """Every character as an end, and as what stands inside white space."""
    assert "regexp" not in str(text.strip(F.col("x"))).lower()  # a pattern is tried at every character of a text
    chars = [chr(c) for c in range(1, 0x3100) if not 0xD800 <= c < 0xE000]
    rows = spark.createDataFrame([(f"{x}{c} a{c} b{c}{y}",) for c in chars for x, y in (("", ""), (" ", "\n"))], "t string")
    by_pattern = F.regexp_replace("t", rf"^{text.WHITESPACE}++|{text.WHITESPACE}++$", "")
    assert rows.where(text.strip(F.col("t")) != by_pattern).count() == 0


def test_strip_removes_unicode_space(spark):
    assert column(spark, ["　 a b\t ", " \n ", "x\x1f"], text.strip) == ["a b", "", "x"]


@pytest.mark.parametrize("raw, expected", [
    ("2026/02/01 8:12", "2026-02-01 08:12:00"),
    ("2024-02-01", "2024-02-01 00:00:00"),
    ("2024-02-05T10:05:00+09:00", "2024-02-05 01:05:00"),
    ("2024-02-05 10:05:30 +0900", "2024-02-05 01:05:30"),
    ("2024-02-05T10:05:00Z", "2024-02-05 10:05:00"),
    ("20240205", "2024-02-05 00:00:00"),
    ("02/13/2024", "2024-02-13 00:00:00"),
    ("13/02/2024", "2024-02-13 00:00:00"),
    ("Feb 3, 2024", "2024-02-03 00:00:00"),
    ("3 Feb 2024", "2024-02-03 00:00:00"),
    (" 2024-02-01　", "2024-02-01 00:00:00"),
    (" Feb 3 2024", "2024-02-03 00:00:00"),
    ("February 3, 2024", "2024-02-03 00:00:00"),
    ("3 Sept. 2024", "2024-09-03 00:00:00"),
    ("Feb 3, 2024 10:05", "2024-02-03 10:05:00"),
    ("2/3/2024 3:05 PM", "2024-02-03 15:05:00"),
    ("2/3/2024 12:05 am", "2024-02-03 00:05:00"),
    ("2024-02-03T10", "2024-02-03 10:00:00"),
    ("Sat, 03 Feb 2024 10:05:00 GMT", "2024-02-03 10:05:00"),
    ("Tuesday 6 February 2024", "2024-02-06 00:00:00"),
    ("20240203101500", "2024-02-03 10:15:00"),
    ("2024-02-03 10:05:00+09", "2024-02-03 01:05:00"),
    ("2/3/2024 13:05 PM", None), ("Foo 3 2024", None), ("Feb 30 2024", None), ("3:05 PM", None),
    ("2024/2/30", None), ("15/2", None), ("abc", None), ("", None), ("   ", None), (None, None),
])
def test_posted_at(spark, raw, expected):
    assert column(spark, [raw], lambda c: posted_at_iso(c).cast("string")) == [expected]


def test_uuid5_matches_the_standard_library(spark):
    rng = random.Random(3)
    pool = "abcXYZ019|éüß日本😂 "
    names = ["".join(rng.choices(pool, k=rng.randint(0, 30))) for _ in range(300)]
    assert column(spark, names, ids.uuid5) == [str(uuid.uuid5(uuid.NAMESPACE_URL, n)) for n in names]


def test_review_id_needs_both_parts(spark):
    rows = spark.createDataFrame(
        [("a", "1"), ("", "1"), ("a", ""), (None, "1"), ("a", None), (" ", "1")], "s string, i string")
    out = [r.x for r in rows.select(ids.review_id(F.col("s"), F.col("i")).alias("x")).collect()]
    assert out[0] == str(uuid.uuid5(uuid.NAMESPACE_URL, "a|1"))
    assert out[1:5] == [None] * 4
    assert out[5] is not None
