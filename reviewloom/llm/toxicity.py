"""Toxicity by a learned lexicon: a trie walked with Levenshtein automata, and context windows."""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewloom.llm.common import column, text_batches, text_of
from reviewloom.session import land

WORD = re.compile(r"[^\W_]+")
#: Opening and closing marks of quotations, and words that report speech.
QUOTES = "\"“”„«»‹›"
REPORTING = frozenset(
    "said says wrote called quote quoted word term dit disait mot sagte schrieb wort dijo palabra".split()
)
WINDOW = 6
REMEMBERED = 50_000
FUZZY_SHARE = 0.8
FEATURES = 6


@dataclass
class Node:
    children: dict[str, "Node"] = field(default_factory=dict)
    weight: float = 0.0  # of the term that ends here
    stem: bool = False  # whether longer words match the term as well


def _shortened(word: str) -> list[str]:
    """The word without one of its letters."""
    return [word[:i] + word[i + 1 :] for i in range(len(word))]


class Lexicon:
    """Terms with weights; a term is a whole word, or a stem (ends in ``*``) that begins words.

    ``lookup`` returns (weight, edits): the heaviest exact term, or else the heaviest whole-word
    term within one edit (a swap of neighbouring letters is one; terms of ``swapped_from`` letters
    up to ``fuzzy_from`` are found by a swap only), of those with at least ``fuzzy_from`` letters and ``fuzzy_share`` of the
    largest weight (``whole_lexicon``, which the query uses, has 0: all of them). The automaton of a
    word is simulated as rows of edit distances, one per trie node on the way; a branch is left when
    its whole row exceeds one edit. Only words that share themselves, or themselves without one
    letter, with a term in the same way are walked; all words within one edit do.
    """

    def __init__(
        self,
        terms: dict[str, float],
        fuzzy_from: int = 5,
        fuzzy_share: float = FUZZY_SHARE,
        swapped_from: int = 4,
        near: dict[str, float] | None = None,
    ) -> None:
        self.root, self.fuzzy_from = Node(), fuzzy_from
        self.fuzzy = Node()
        least = fuzzy_share * max(terms.values(), default=0.0)
        self.near: set[str] = set()
        self.longest = 0
        self.swapped: dict[str, float] = {}
        for term, weight in terms.items():
            self._add(self.root, term.rstrip("*"), weight, term.endswith("*"))
            if term.endswith("*") or weight < least:
                continue
            weight = (near or {}).get(term, weight)
            if weight <= 0:
                continue
            if len(term) >= fuzzy_from:
                self._add(self.fuzzy, term, weight, False)
                self.near |= {term, *_shortened(term)}
                self.longest = max(self.longest, len(term))
            elif len(term) >= swapped_from:
                for i in range(len(term) - 1):
                    other = term[:i] + term[i + 1] + term[i] + term[i + 2 :]
                    self.swapped[other] = max(self.swapped.get(other, 0.0), weight)
        self.known: dict[str, tuple[float, int]] = {}

    @staticmethod
    def _add(node: Node, letters: str, weight: float, stem: bool) -> None:
        for letter in letters:
            node = node.children.setdefault(letter, Node())
        node.weight, node.stem = max(node.weight, weight), node.stem or stem

    def lookup(self, word: str) -> tuple[float, int]:
        found = self.known.get(word)
        if found is None:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            found = self.known[word] = self._lookup(word)
        return found

    def _lookup(self, word: str) -> tuple[float, int]:
        node, weight = self.root, 0.0
        for i, letter in enumerate(word):
            node = node.children.get(letter)
            if node is None:
                break
            if node.weight > weight and (node.stem or i == len(word) - 1):
                weight = node.weight
        if weight:
            return weight, 0
        weight = self.swapped.get(word, 0.0)
        if self.fuzzy_from - 1 <= len(word) <= self.longest + 1 and (
            word in self.near or not self.near.isdisjoint(_shortened(word))
        ):
            row = list(range(len(word) + 1))
            weight = max(weight, self._within_one(self.fuzzy, word, row, row, ""))
        return (weight, 1) if weight else (0.0, 0)

    def _within_one(
        self, node: Node, word: str, row: list[int], above: list[int], last: str
    ) -> float:
        """``above`` is the row before ``row``, and ``last`` the letter that led from it to ``row``."""
        best = node.weight if row[-1] <= 1 else 0.0
        for letter, child in node.children.items():
            step = [row[0] + 1]
            for i, own in enumerate(word):
                edits = min(row[i] + (own != letter), row[i + 1] + 1, step[i] + 1)
                if i and own == last and word[i - 1] == letter:
                    edits = min(edits, above[i - 1] + 1)
                step.append(edits)
            if min(step) <= 1:
                best = max(best, self._within_one(child, word, step, row, letter))
        return best


def whole_lexicon(terms: dict[str, float], near: dict[str, float] | None = None) -> Lexicon:
    """Every whole word long enough for one edit is sought misspelt, whatever its weight; ``near`` may
    give misspellings a weight of their own."""
    return Lexicon(terms, fuzzy_share=0.0, near=near)


def near_terms(terms: list[str]) -> Callable[[str], list[str]]:
    """For a word the whole-word terms that it may be a misspelling of."""
    alone = {t: whole_lexicon({t: 1.0}) for t in terms if not t.endswith("*")}
    by_part: dict[str, set[str]] = {}
    for term in alone:
        swapped = [term[:i] + term[i + 1] + term[i] + term[i + 2 :] for i in range(len(term) - 1)]
        for part in (term, *_shortened(term), *swapped):
            by_part.setdefault(part, set()).add(term)

    def found(word: str) -> list[str]:
        near = set().union(*(by_part.get(part, ()) for part in (word, *_shortened(word))))
        return [t for t in near if alone[t].lookup(word)[1]] if near and word not in alone else []

    return found


def features(text: str, lexicon: Lexicon) -> list[float]:
    """Sums over hits, log-scaled: exact and misspelt hits meant, hits quoted, the heaviest hit
    meant, hits per word, and a constant.

    A hit is quoted when an odd number of quotation marks stands before it in its line, or a
    reporting word within the ``WINDOW`` words before it.
    """
    lowered = text.lower()
    marked = {w: f for w in set(WORD.findall(lowered)) if (f := lexicon.lookup(w))[0]}
    exact = misspelt = quoted = top = 0.0
    n = hits = 0
    if marked:
        before: list[str] = []
        line_start, marks, counted = 0, 0, 0
        for match in WORD.finditer(lowered):
            word = match.group()
            n += 1
            found = marked.get(word)
            if found:
                hits += 1
                at = match.start()
                cut = lowered.rfind("\n", counted, at)
                if cut >= 0:
                    line_start, marks, counted = cut + 1, 0, cut + 1
                marks += sum(lowered.count(q, counted, at) for q in QUOTES)
                counted = at
                if marks % 2 or not REPORTING.isdisjoint(before[-WINDOW:]):
                    quoted += found[0]
                else:
                    top = max(top, found[0] / (1 + found[1]))
                    if found[1]:
                        misspelt += found[0]
                    else:
                        exact += found[0]
            before.append(word)
            if len(before) > 64:
                del before[:-WINDOW]
    return [
        math.log1p(exact),
        math.log1p(misspelt),
        math.log1p(quoted),
        top,
        math.log1p(100 * ((exact + misspelt) / 10) / n) if n else 0.0,
        1.0,
    ]


def misspell(text: str, terms: dict[str, float]) -> str:
    """The text with each whole-word term misspelt, by a swap of two inner letters or, if they are the
    same, without one of them; which ones follows from the word's place. Terms of three letters stay."""

    def wrong(match: re.Match) -> str:
        word = match.group()
        if word.lower() not in terms or len(word) < 4:
            return word
        i = 1 + zlib.crc32(f"{match.start()} {word}".encode()) % (len(word) - 3 + (len(word) > 4))
        if i + 1 < len(word) and word[i] != word[i + 1]:
            return word[:i] + word[i + 1] + word[i] + word[i + 2 :]
        return word[:i] + word[i + 1 :] if len(word) > 4 else word

    return WORD.sub(wrong, text)


def held_out(id_col: Column) -> Column:
    return F.crc32(id_col.cast("string").cast("binary")) % 4 == 2


@dataclass(frozen=True)
class Model:
    """Log-odds of terms, those of their misspellings, and the weights of the features."""

    terms: dict[str, float]
    weights: tuple[float, ...]
    near: dict[str, float] = field(default_factory=dict)


def _terms_of(text: Column) -> Column:
    """Distinct words of a text and their beginnings of 4 to 9 letters, marked ``*``."""
    words = F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(r"([\p{L}\p{Nd}]+)"), 1))
    long = F.filter(words, lambda w: F.length(w) >= 4)
    stems = F.flatten(
        F.transform(
            long,
            lambda w: F.transform(
                F.sequence(F.lit(4), F.least(F.length(w), F.lit(9))),
                lambda k: F.concat(F.substring(w, F.lit(1), k), F.lit("*")),
            ),
        )
    )
    return F.array_distinct(F.concat(words, stems))


def training_rows(docs: DataFrame, labels: DataFrame, max_rows: int) -> DataFrame:
    """``text``, ``toxic`` of the at most ``max_rows`` labelled rows of least hash outside the held-out
    quarter: a bounded sample, so its ids may be broadcast. Unlabelled and null ids don't count."""
    chosen = (
        labels.where(~held_out(F.col("doc_id")) & F.col("toxic").isNotNull())
        .groupBy(F.col("doc_id").alias("l_id"))
        .agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("l_id"), "l_id")
        .limit(max_rows)
    )
    on = column(docs, "doc_id") == F.col("l_id")
    return docs.join(F.broadcast(chosen), on).select(text_of(docs, "text").alias("text"), "toxic")


def fit(
    docs: DataFrame, labels: DataFrame, max_rows: int = 20_000, max_terms: int = 1_000
) -> Model:
    """Lexicon and feature weights from the training rows.

    Terms are counted per label by a grouped aggregation; kept are the at most ``max_terms`` of
    smoothed log-odds of 2 or more held by 5 or more toxic rows; a stem must be held by clearly more
    of them than any one whole word it begins, and takes no place among the terms else. Only these, and ``FEATURES`` numbers for each
    training row, reach the driver, where a logistic regression is fitted. Rows with whole-word terms
    train it once more with these misspelt, as few texts misspell by themselves, and no hit may lower a
    score, so a misspelt insult counts like an insult and more than none.
    Without toxic training rows every score is the same.
    """
    rows = training_rows(docs, labels, max_rows)
    totals = rows.agg(F.sum("toxic").alias("p"), F.count("*").alias("n")).first()
    p, n = totals.p or 0, totals.n
    held = rows.select(F.explode(_terms_of(F.col("text"))).alias("term"), "toxic")
    counts = land(
        held.groupBy("term").agg(F.sum("toxic").alias("pos"), F.count("*").alias("all")), "term-counts")
    odds = F.log((F.col("pos") + 0.5) / (p + 1)) - F.log(
        (F.col("all") - F.col("pos") + 0.5) / (n - p + 1)
    )
    best = land(counts.where("pos >= 5").withColumn("odds", odds).where("odds >= 2"), "terms")
    stem = F.col("term").endswith("*")
    begun = best.where(~stem & (F.length("term") >= 4)).select(
        F.explode(
            F.transform(
                F.sequence(F.lit(4), F.least(F.length("term"), F.lit(9))),
                lambda k: F.concat(F.substring("term", F.lit(1), k), F.lit("*")),
            )
        ).alias("begun"),
        "pos",
    )
    begun = begun.groupBy("begun").agg(F.max("pos").alias("alone"))
    best = best.join(begun, F.col("term") == F.col("begun"), "left")
    best = best.where(~stem | (F.col("pos") > 1.2 * F.coalesce("alone", F.lit(0))))
    best = best.orderBy(F.desc("odds"), F.desc("pos"), "term").limit(max_terms)
    kept = best.collect()
    terms = {r.term: float(r.odds) for r in kept}
    near = _near_weights(counts, terms, {r.term: r.pos for r in kept}, p, n)
    x, y = [], []
    wrong = F.udf(lambda text: misspell(text, terms), "string")
    wrongly = rows.withColumn("wrong", wrong("text")).where("wrong <> text")
    trained = rows.unionByName(wrongly.select(F.col("wrong").alias("text"), "toxic"))
    with text_batches(docs.sparkSession):
        featured = _featured(trained, terms, near, ["toxic"]).collect()
    for row in featured:
        x.append(row.features)
        y.append(row.toxic)
    if not p or p == n:
        return Model(terms, (0.0,) * (FEATURES - 1) + (-20.0 if not p else 20.0,), near)
    return Model(terms, tuple(_logistic(np.array(x), np.array(y, dtype=float))), near)


def _near_weights(
    counts: DataFrame, terms: dict[str, float], held: dict[str, int], p: int, n: int
) -> dict[str, float]:
    """Log-odds of the misspellings of each whole-word term, from 0 to those of the term.

    Each row that holds the term is taken to misspell it once as well; against that stand the words of
    the training rows that are within one edit of the term by chance. One row per term is collected.
    """
    if not terms:
        return {}

    @F.pandas_udf("array<string>")
    def near(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        found = near_terms(list(terms))
        for words in batches:
            yield pd.Series([found(word) for word in words])

    words = counts.where(~F.col("term").endswith("*") & (F.length("term") >= 3))
    chance = words.select(F.explode(near("term")).alias("near"), "pos", "all").groupBy("near").agg(
        F.sum("pos").alias("pos"), F.sum("all").alias("all")
    )
    weights = {}
    for row in chance.collect():
        odds = math.log((row["pos"] + held[row["near"]] + 0.5) / (p + 1)) - math.log(
            (row["all"] - row["pos"] + 0.5) / (n - p + 1)
        )
        weights[row["near"]] = min(max(odds, 0.0), terms[row["near"]])
    return weights


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights without negative ones but for the constant, the last: those of features whose weight
    would be negative are 0, and the others fitted without them."""
    used = np.ones(x.shape[1], dtype=bool)
    while True:
        w = np.zeros(x.shape[1])
        w[used] = _newton(x[:, used], y)
        negative = (w < 0) & (np.arange(len(w)) < len(w) - 1)
        if not negative.any():
            return w
        used[np.argmin(np.where(negative, w, 0))] = False


def _newton(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(w))
        step = np.linalg.solve(hessian, x.T @ (y - p) - 0.1 * w)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return w


def _featured(
    rows: DataFrame, terms: dict[str, float], near: dict[str, float], keep: list[str]
) -> DataFrame:
    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def featured(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        lexicon = whole_lexicon(terms, near)
        for texts in batches:
            yield pd.Series([features(t, lexicon) for t in texts])

    return rows.select(*keep, featured("text").alias("features"))


def toxicity(
    docs: DataFrame, labels: DataFrame, threshold: float = 0.3, **limits: int
) -> DataFrame:
    """Per row: ``doc_id``, ``held_out``, ``score`` in 0..1, ``predicted``.

    Scores see the text only. Texts without a hit, empty and null ones among them, get the score of
    no evidence. Rows repeated are scored alike; a null id is not held out. Scoring is one pass over
    whole texts without a shuffle.
    """
    model = fit(docs, labels, **limits)
    rows = docs.select(column(docs, "doc_id").alias("doc_id"), text_of(docs, "text").alias("text"))
    scored = _featured(rows, model.terms, model.near, ["doc_id"])
    logit = sum(F.get("features", F.lit(i)) * F.lit(float(w)) for i, w in enumerate(model.weights))
    return scored.select("doc_id", (1 / (1 + F.exp(-logit))).alias("score")).select(
        "doc_id",
        F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
