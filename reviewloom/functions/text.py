"""Text normalisation as chained column expressions."""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass
from functools import partial

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WHITESPACE = r"(?U)[\s\x1c-\x1f]"

# Characters that end a sentence wherever they stand, ...
SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(
    chr(c) for c in range(0x2000, 0x200B)
)
FACES = "😉😁😂😃😄😅😆😇😈😉😊😋😌😍😎😏😐😑😒😓😔😕😖😗😘😙😚😛😜😝😞😟😠😡😢😣😤😥😦😧😨😩😪😫😬😭😮😯😰😱😲😳😴😵😶😷😸😹😺😻😼😽😾😿🙀🙁🙂🙃🙄🤐🤑🤒🤓"
GESTURES = "🙇\u200d🙏☔\ufe0f🙋💦"
SENTENCE_MARKS = "!?。…()#" + SPACES + FACES + GESTURES

# ... and runs that end one from a certain length on.
SENTENCE_RUNS = (r"、、+", r"\.\.\.+", r"・・・+", r"wwww+")

# Space-delimited languages: spaces separate words, sentences end at punctuation.
SPACED_MARKS = ".!?…()[]{}#"

_FULLWIDTH = "".join(chr(c) for c in range(0xFF01, 0xFF5F)) + "　"
_HALFWIDTH = "".join(chr(c) for c in range(0x21, 0x7F)) + " "

# Japanese orthographic rules: (pattern, replacement), in order.
ORTHOGRAPHY = [
    (r"[˗֊‐‑‒–⁃⁻₋−]+", "-"),
    (r"[﹣－ｰ—―─━ー]+", "ー"),
    (r"[~∼∾〜〰～]+", ""),
    (r"[’]", "'"),
    (r"[”“]", "\""),
    (r" {2,}", " "),
    (r"(?<=[぀-ヿ一-鿿]) +(?=[぀-ヿ一-鿿])", ""),
    (r"(?<=[぀-ヿ一-鿿]) +(?=[ -~])", ""),
    (r"(?<=[ -~]) +(?=[぀-ヿ一-鿿])", ""),
    (r"^ +| +$", ""),
]


@dataclass(frozen=True)
class TextProfile:
    """How a language's text is folded and cut into sentences."""

    marks: str = SENTENCE_MARKS
    runs: tuple[str, ...] = SENTENCE_RUNS
    full_nfkc: bool = True
    orthography: bool = True
    fold_first: bool = False


JAPANESE = TextProfile()
SPACED = TextProfile(SPACED_MARKS, (), full_nfkc=False, orthography=False)


def strip(text: Column) -> Column:
    """Remove Unicode white space (``WHITESPACE``, here as characters) at both ends."""
    return F.btrim(text, F.lit(SPACES))


def cut_sentences(text: Column, marks: str = SENTENCE_MARKS, runs: tuple[str, ...] = SENTENCE_RUNS) -> Column:
    """Put one "|" wherever marks or runs end a sentence.

    Neighbouring ends count once, so marks can be replaced one by one in a single pass, and a second
    pass over runs joins what stands together. Bracketed faces need no pattern of their own: their
    brackets are marks. Without runs one pass over a class of characters does it all.
    """
    if not runs:
        return F.regexp_replace(text, "[" + "".join(rf"\x{{{ord(c):x}}}" for c in "|" + marks) + "]++", "|")
    bars = F.translate(text, marks, "|" * len(marks))
    return F.regexp_replace(bars, "(?:" + "|".join([r"\|", *runs]) + ")++", "|")


def fold_width(text: Column) -> Column:
    """Full-width ASCII and the ideographic space to half-width; the native part of NFKC."""
    return F.translate(text, _FULLWIDTH, _HALFWIDTH)


@F.pandas_udf(T.StringType())
def nfkc(texts: pd.Series) -> pd.Series:
    """Full NFKC folding in Arrow batches; Spark has no built-in for it."""
    return texts.str.normalize("NFKC")


def _steady() -> str:
    """Pattern for texts that NFKC cannot change: characters below the combining marks that have no
    other form, as only marks and later letters ever compose with what stands before them.

    The characters stand as ranges: a class of single ones is searched one by one for every character.
    """
    kept = [c for c in range(0x300) if unicodedata.normalize("NFKC", chr(c)) == chr(c)]
    starts = [c for c in kept if c - 1 not in kept]
    ends = [c for c in kept if c + 1 not in kept]
    return "^[" + "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in zip(starts, ends)) + "]*+$"


def with_nfkc(rows: DataFrame, source: str, target: str) -> DataFrame:
    """``rows`` with ``target``, the NFKC form of ``source``; only rows that may change go through Python."""
    steady = F.coalesce(F.col(source).rlike(_steady()), F.lit(True))
    return rows.where(steady).withColumn(target, F.col(source)).unionByName(
        rows.where(~steady).withColumn(target, nfkc(F.col(source))))


def orthography(text: Column) -> Column:
    for pattern, replacement in ORTHOGRAPHY:
        text = F.regexp_replace(text, pattern, replacement)
    return text


def normalise(text: Column, profile: TextProfile = JAPANESE) -> Column:
    """Cut sentences, fold compatibility forms, unify spelling and case, in that order."""
    fold = nfkc if profile.full_nfkc else fold_width
    cut = partial(cut_sentences, marks=profile.marks, runs=profile.runs)
    ascii_only = F.octet_length(text) == F.length(text)  # nothing to fold, and most texts of some languages
    if profile.full_nfkc:
        text = cut(fold(text)) if profile.fold_first else fold(cut(text))
    elif profile.fold_first:
        text = cut(F.when(ascii_only, text).otherwise(fold(text)))
    else:
        text = F.when(ascii_only, cut(text)).otherwise(fold(cut(text)))
    if profile.orthography:
        text = orthography(text)
    return F.lower(text)
