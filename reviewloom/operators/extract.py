"""Set-based extraction of (subjects, predicates) around polarity terms.

Nouns that may be subjects cut a review into gaps. Whether two neighbouring subject nouns belong
together depends only on the gap between them, so subjects form islands within a sentence and the
subjects of any term are the part of one island up to an anchor noun. Predicates of a term are the
predicate words of one or two gaps, or, where the own sentence has no subject, of a run of
sentences.

Pairs are formed for all reviews of a block at once. Tokens go to Python as numbers; nouns and predicates
are counted up to each, and carry pointers: the island, the neighbours of the same lemma. So whatever a
term needs is an element at a known place or a range between two, and a block costs time in proportion to
its words and to what is walked. Subjects alone (``gather``, ``find_nouns``) are found by a window and an
array per review. Both use the partitioning by ``row_id`` that tokens come with.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema
from pyspark.sql.window import WindowSpec

from reviewloom.functions import blocks
from reviewloom.functions.arrays import let, places, spread


@dataclass(frozen=True)
class TokenRules:
    """Which tags play which role; the defaults are the fixed values of the Japanese rules."""

    noun: str = "名詞"
    adjective: str = "形容詞"
    adjectival_noun: str = "形容動詞"
    particle: str = "助詞"
    auxiliary: str = "助動詞"
    predicates: tuple[str, ...] = ("動詞", "形容詞", "形容動詞")
    no_subject: tuple[str, ...] = ("非自立", "副詞可能", "接尾", "代名詞", "特殊", "数")
    no_subject_lemmas: tuple[str, ...] = ("ー", "人", "人達", "者", "子", "方", "やつ", "奴", "こと", "事")
    linking_particles: tuple[str, ...] = ("けど", "のに", "から", "て", "ば")
    conditional: str = "仮定形"
    transparent_nouns: tuple[str, ...] = ("ん",)
    no_predicate: tuple[str, ...] = ("非自立", "接尾")
    no_predicate_lemmas: tuple[str, ...] = ("過ぎる", "すぎる")
    not_modified: tuple[str, ...] = ("非自立", "接尾", "代名詞", "特殊")
    adnominal_auxiliaries: tuple[str, ...] = ("な",)
    adnominal_inflection: str = "体言接続"
    adnominal_particles: tuple[str, ...] = ("の",)
    adnominal_field: str = "surface"


JAPANESE_RULES = TokenRules()
SPACED_RULES = TokenRules(adnominal_field="lemma")

# One letter per role: subject noun, blocking noun, verbal word, clause link, none.
SUBJECT, BLOCKER, VERBAL, LINK, PLAIN = "N", "n", "V", "m", "o"

# A gap between two subject nouns of one sentence that keeps them apart: it has a verbal word that a noun
# follows before any link does.
_APART = rf"{VERBAL}({PLAIN})*({BLOCKER}|$)"


def assign_roles(tokens: DataFrame, rules: TokenRules = JAPANESE_RULES) -> DataFrame:
    """Flag subject nouns, blocking nouns, predicate words, predicates and clause links."""
    pos, lemma = F.col("pos"), F.col("lemma")
    sub_pos = F.coalesce("sub_pos", F.lit("*"))
    inflection = F.coalesce("inflection", F.lit("*"))
    noun, verbal = pos == rules.noun, pos.isin(*rules.predicates)
    barred = sub_pos.isin(*rules.no_subject)
    return tokens.withColumns({
        "is_subject": noun & ~barred & ~lemma.isin(*rules.no_subject_lemmas),
        "is_blocker": noun & barred & ~lemma.isin(*rules.transparent_nouns),
        "is_verbal": verbal,
        "is_predicate": verbal & ~sub_pos.isin(*rules.no_predicate) & ~lemma.isin(*rules.no_predicate_lemmas),
        "is_link": ((pos == rules.particle) & lemma.isin(*rules.linking_particles))
        | ((pos == rules.auxiliary) & (inflection == rules.conditional)),
        "is_modifiable": noun & ~sub_pos.isin(*rules.not_modified),
        "is_adnominal": ((pos == rules.auxiliary) & (inflection == rules.adnominal_inflection)
                         & F.col(rules.adnominal_field).isin(*rules.adnominal_auxiliaries))
        | ((pos == rules.particle) & F.col(rules.adnominal_field).isin(*rules.adnominal_particles)),
    })


def _reading() -> WindowSpec:
    return Window.partitionBy("row_id").orderBy("sentence", "place")


def _shown(rules: TokenRules) -> Column:
    """What a token shows to the words before it, packed into one number, as every token row carries two of
    them: the sentence, and a bit each for a noun that can be modified, an adnominal word and an auxiliary."""
    return (
        F.col("sentence") * 8
        + F.when(F.col("is_modifiable"), 4).otherwise(0)
        + F.when(F.col("is_adnominal"), 2).otherwise(0)
        + F.when(F.col("pos") == rules.auxiliary, 1).otherwise(0)
    )


def modifies_noun(rules: TokenRules = JAPANESE_RULES) -> Column:
    """True for an adjective before a noun, directly or over one auxiliary, and for an adjectival
    noun before an adnominal word and a noun, all in one sentence.

    ``ahead_1`` and ``ahead_2`` hold what the next two tokens show.
    """
    noun, adnominal, auxiliary = 4, 2, 1

    def ahead(n: int, bit: int) -> Column:
        word = F.col(f"ahead_{n}")
        return (F.floor(word / 8) == F.col("sentence")) & (word.bitwiseAND(bit) != 0)

    return ((F.col("pos") == rules.adjective) & (ahead(1, noun) | (ahead(1, auxiliary) & ahead(2, noun)))) | (
        (F.col("pos") == rules.adjectival_noun) & ahead(1, adnominal) & ahead(2, noun)
    )


def _count_upto(flag: str) -> Column:
    so_far = _reading().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return F.count_if(F.col(flag)).over(so_far).cast("int")


def role_of(values: dict[str, Column]) -> Column:
    """What stands for the role of a token."""
    return (
        F.when(F.col("is_subject"), values[SUBJECT])
        .when(F.col("is_blocker"), values[BLOCKER])
        .when(F.col("is_verbal"), values[VERBAL])
        .when(F.col("is_link"), values[LINK])
        .otherwise(values[PLAIN])
    )


def gather(tokens: DataFrame, rules: TokenRules = JAPANESE_RULES) -> DataFrame:
    """One row per review: the words that play a role, in reading order, and their roles as letters.

    Words without a role have served once positions and neighbours are known. Positions are numbered
    here again, in the window of the neighbours, so that an earlier numbering need not run.
    """
    roles = assign_roles(tokens, rules)
    kind = (
        F.when(F.col("pos") == rules.noun, "noun")
        .when(modifies_noun(rules), "modifier")
        .when(F.col("is_verbal"), "verbal")
        .otherwise("other")
    )
    role = role_of({role: F.lit(role) for role in (SUBJECT, BLOCKER, VERBAL, LINK, PLAIN)})
    word = F.struct(
        "index", "sentence", "nouns_upto", "verbs_upto", "role", "kind", "is_predicate", "lemma", "entity",
        "issue_category", "polarities")
    # the struct is a column of its own, so that collecting copies a finished row; and a native sort, as that of
    # array_sort evaluates its comparison as an expression
    words = F.sort_array(F.collect_list("word"))
    letters = F.array_join(F.col("words")["role"], "")
    shown = _shown(rules)
    return (
        roles.select(
            "row_id", "run_id", "review_id", (F.row_number().over(_reading()) - 1).alias("index"), "sentence", "pos",
            _count_upto("is_subject").alias("nouns_upto"), _count_upto("is_predicate").alias("verbs_upto"),
            F.lead(shown, 1, 0).over(_reading()).alias("ahead_1"), F.lead(shown, 2, 0).over(_reading()).alias("ahead_2"),
            "is_verbal", "is_predicate", "lemma", "entity", "issue_category", "polarities", role.alias("role"))
        .where((F.col("role") != PLAIN) | F.col("polarities").isNotNull())
        .withColumn("kind", kind)
        .select("row_id", "run_id", "review_id", word.alias("word"))
        .groupBy("row_id", "run_id", "review_id")
        .agg(words.alias("words"))
        .withColumn("gaps", F.split(letters, SUBJECT))
    )


def find_nouns(gathered: DataFrame) -> DataFrame:
    """Add the numbered subject ``nouns``, each with the number of the first noun of its island and
    the predicates up to it."""
    def numbered(subjects: Column) -> Column:
        def starts(gap: Column, i: Column) -> Column:
            other_sentence = F.get(subjects, i)["sentence"] != F.get(subjects, i - 1)["sentence"]
            return (i == 0) | other_sentence | gap.rlike(_APART)

        # gap n, from 0, is the one before noun n + 1; the last gap, after all nouns, starts nothing
        heads = places(F.slice("gaps", F.lit(1), F.size("gaps") - 1), starts)
        return let(spread(heads, lambda head, _: head + 1, F.size("gaps") - 1), lambda islands: F.transform(
            subjects, lambda w, i: F.struct(
                w["index"].alias("index"), w["sentence"].alias("sentence"), (i + 1).alias("nth"),
                F.get(islands, i).alias("island"), w["verbs_upto"].alias("verbs_upto"),
                w["lemma"].alias("lemma"), w["entity"].alias("entity"),
            )))

    return gathered.withColumn("nouns", let(F.filter("words", lambda w: w["role"] == SUBJECT), numbered))


# What a token shows to the pairs of its review, packed into one number: its role, and a bit for each flag.
_ROLES = {role: number for number, role in enumerate((PLAIN, SUBJECT, BLOCKER, VERBAL, LINK))}
_FLAGS = {name: 8 << number for number, name in enumerate((
    "is_verbal", "is_predicate", "is_modifiable", "is_adnominal", "noun", "adjective", "adjectival_noun", "auxiliary"))}

_RULES = (
    "noun_then_predicate", "noun_as_predicate", "noun_alone", "subject_before", "subject_after",
    "earlier_sentence", "later_sentence", "no_subject", "modifier", "other")
_RULE = {name: number for number, name in enumerate(_RULES)}
#: Predicates that walks look at in one go.
WALKED = 1_000_000
#: Subjects that the reasons of a row hold in all, beyond which a review's pairs go to several rows.
ROW_SUBJECTS = 50_000
#: Stands for no noun, no predicate.
NONE = -1


def _choose(cases: list[tuple[np.ndarray, np.ndarray | int]], otherwise: np.ndarray | int) -> np.ndarray:
    return np.select([c for c, _ in cases], [v for _, v in cases], otherwise)


class _Tokens:
    """The tokens of a block of reviews. Nouns (subjects) and verbs (predicates) are numbered from 1 through the
    block, so a count up to a place is the number of the last one; ``none_before`` and ``last`` bound a review's.
    """

    def __init__(self, shown: np.ndarray, sentence: np.ndarray, lemma: np.ndarray, starts: np.ndarray) -> None:
        n = len(shown)
        self.sentence, self.lemma = sentence, lemma
        self.role = shown & 7
        self.flag = {name: (shown & bit) != 0 for name, bit in _FLAGS.items()}
        self.review = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, n)))
        self.starts = starts
        self.begins_review = np.zeros(n, bool)
        self.begins_review[starts] = True
        begins_sentence = self.begins_review.copy()
        begins_sentence[1:] |= sentence[1:] != sentence[:-1]
        # where the sentence of a token begins, and where the next one does
        at = np.flatnonzero(begins_sentence)
        number = np.cumsum(begins_sentence) - 1
        self.own_start, self.own_stop = at[number], np.append(at[1:], n)[number]

        self.is_noun, self.is_verb = self.role == _ROLES[SUBJECT], self.flag["is_predicate"]
        self.nouns = np.concatenate(([0], np.cumsum(self.is_noun)))  # up to, not including, a place
        self.verbs = np.concatenate(([0], np.cumsum(self.is_verb)))
        ends = np.append(starts[1:], n)
        self.review_nouns = self.nouns[starts], self.nouns[ends]
        self.review_verbs = self.verbs[starts], self.verbs[ends]
        # place of the noun or verb of a number; a place more, as nothing has the number 0
        self.noun_at = np.concatenate(([0], np.flatnonzero(self.is_noun)))
        self.verb_at = np.concatenate(([0], np.flatnonzero(self.is_verb)))
        self.kind = self._kinds()
        self.island = self._islands()
        self._link_verbs()

    def _ahead(self, name: str, by: int) -> np.ndarray:
        """Whether the next token, or the one after it, of the same sentence has a flag."""
        found = np.zeros(len(self.role), bool)
        found[:-by] = self.flag[name][by:] & (self.own_start[by:] == self.own_start[:-by])
        return found

    def _kinds(self) -> np.ndarray:
        """As in :func:`gather`: noun, modifier (see :func:`modifies_noun`), verbal or other."""
        noun_second = self._ahead("is_modifiable", 2)
        modifier = self.flag["adjective"] & (
            self._ahead("is_modifiable", 1) | (self._ahead("auxiliary", 1) & noun_second))
        modifier |= self.flag["adjectival_noun"] & self._ahead("is_adnominal", 1) & noun_second
        return _choose([(self.flag["noun"], 0), (modifier, 1), (self.flag["is_verbal"], 2)], 3)

    def _islands(self) -> np.ndarray:
        """Number of the first noun of the island of each noun, see :func:`find_nouns`."""
        playing = np.flatnonzero(self.role != _ROLES[PLAIN])
        roles = self.role[playing]
        # a verbal word keeps the nouns around it apart if a noun follows before any link does
        apart = np.zeros(len(self.role), bool)
        noun_next = np.isin(roles[1:], (_ROLES[SUBJECT], _ROLES[BLOCKER]))
        apart[playing[:-1][(roles[:-1] == _ROLES[VERBAL]) & noun_next]] = True
        walls = np.cumsum(apart)
        at = self.noun_at[1:]
        heads = np.ones(len(at), bool)
        heads[1:] = (self.own_start[at[1:]] != self.own_start[at[:-1]]) | (walls[at[1:]] != walls[at[:-1]])
        return np.concatenate(([0], blocks.last_set(heads) + 1))

    def _link_verbs(self) -> None:
        """Pointers of each verb to others of the same lemma in its review.

        ``before`` and ``after`` are the numbers of its neighbours (numbers outside the review without one),
        ``final`` is the last one in the same sentence, and ``fresh`` tells that no earlier sentence has one.
        """
        at = self.verb_at[1:]
        review, lemma, sentence = self.review[at], self.lemma[at], self.own_start[at]
        order = np.lexsort((lemma, review))  # stable: by number within these
        new_lemma = np.ones(len(at), bool)
        new_lemma[1:] = (lemma[order][1:] != lemma[order][:-1]) | (review[order][1:] != review[order][:-1])
        new_run = new_lemma.copy()
        new_run[1:] |= sentence[order][1:] != sentence[order][:-1]
        number = order + 1
        n = len(at)

        def by_number(values: np.ndarray) -> np.ndarray:
            out = np.zeros(n + 1, np.int64)
            out[number] = values
            return out

        self.before = by_number(np.where(new_lemma, self.review_verbs[0][review[order]], np.roll(number, 1)))
        last_lemma = np.roll(new_lemma, -1)
        self.after = by_number(np.where(last_lemma, self.review_verbs[1][review[order]] + 1, np.roll(number, -1)))
        runs, lemmas = np.flatnonzero(new_run), np.flatnonzero(new_lemma)
        sizes = np.diff(np.append(runs, n))
        self.final = by_number(np.repeat(number[runs + sizes - 1], sizes))
        first = np.repeat(sentence[order][lemmas], np.diff(np.append(lemmas, n)))
        self.fresh = by_number(sentence[order] == first) == 1

    def noun_sentence(self, number: np.ndarray, review: np.ndarray) -> np.ndarray:
        """Where the sentence of a review's noun begins, NONE without such a noun."""
        return np.where(number > self.review_nouns[0][review], self.own_start[self.noun_at[np.maximum(number, 0)]], NONE)

    def noun_after(self, verb: np.ndarray) -> np.ndarray:
        """Number of the last noun up to a verb."""
        return self.nouns[self.verb_at[verb] + 1]

    def gap_start(self, noun: np.ndarray, review: np.ndarray) -> np.ndarray:
        """Number of the first verb after a noun (of a review's verbs if it has no such noun)."""
        known = noun > self.review_nouns[0][review]
        return np.where(known, self.verbs[self.noun_at[np.maximum(noun, 0)] + 1], self.review_verbs[0][review]) + 1

    def gap_end(self, noun: np.ndarray, review: np.ndarray) -> np.ndarray:
        """Number of the last verb before the noun after one."""
        known = noun < self.review_nouns[1][review]
        following = self.noun_at[np.where(known, noun + 1, 0)]
        return np.where(known, self.verbs[following + 1], self.review_verbs[1][review])


class _Terms:
    """Rules, subjects and predicates of the terms at some places of a block."""

    def __init__(self, tokens: _Tokens, at: np.ndarray) -> None:
        k = self.tokens = tokens
        self.at, self.review = at, k.review[at]
        self.first_noun, self.first_verb = k.review_nouns[0][self.review] + 1, k.review_verbs[0][self.review] + 1
        self.last_verb = k.review_verbs[1][self.review]
        own = self.own = k.own_start[at]
        self.nth, self.upto = k.nouns[at + 1], k.verbs[at + 1]
        # verbs before the own sentence, and up to its end
        self.start, self.end = k.verbs[own], k.verbs[k.own_stop[at]]
        last = k.nouns[k.own_stop[at]]
        self.own_last = np.where(last > k.nouns[own], last, NONE)
        some = len(k.verb_at) - 1
        self.verb_before = np.where(self.upto > self.start, k.noun_after(self.upto), NONE)
        self.verb_after = np.where(self.upto < self.end, k.noun_after(np.minimum(self.upto + 1, some)), NONE)
        self.near = k.noun_sentence(self.nth, self.review)
        first = np.minimum(self.first_noun, len(k.noun_at) - 1)
        has_noun = k.review_nouns[1][self.review] >= self.first_noun
        self.first = np.where(has_noun, k.own_start[k.noun_at[first]], NONE)
        self.noun_before = self.nth - k.is_noun[at]
        self.rule = self._rules()
        self.anchor = self._anchors()

    def _rules(self) -> np.ndarray:
        """The case that applies to each term."""
        kind = self.tokens.kind[self.at]
        noun, verbal = kind == 0, kind == 2
        before = self.tokens.noun_sentence(self.noun_before, self.review)
        return _choose([
            (noun & (self.verb_after == self.nth), _RULE["noun_then_predicate"]),
            (noun & (before == self.own), _RULE["noun_as_predicate"]),
            (noun, _RULE["noun_alone"]),
            (kind == 1, _RULE["modifier"]),
            (verbal & (self.near == self.own), _RULE["subject_before"]),
            (verbal & (self.own_last != NONE), _RULE["subject_after"]),
            (verbal & (self.near != NONE), _RULE["earlier_sentence"]),
            (verbal & (self.first != NONE), _RULE["later_sentence"]),
            (verbal, _RULE["no_subject"]),
        ], _RULE["other"])

    def is_(self, *names: str) -> np.ndarray:
        return np.isin(self.rule, [_RULE[name] for name in names])

    def _last_noun_of_first(self) -> np.ndarray:
        """Last noun of the sentence of the review's first noun."""
        return self.tokens.nouns[self.tokens.own_stop[np.maximum(self.first, 0)]]

    def _anchors(self) -> np.ndarray:
        """Number of the noun up to which subjects reach, NONE without subjects."""
        after_sentence = self.tokens.noun_sentence(self.verb_after, self.review)
        return _choose([
            (self.is_("noun_then_predicate"), np.where(self.near == self.own, self.nth, NONE)),
            (self.is_("subject_before", "earlier_sentence"), self.nth),
            (self.is_("noun_as_predicate"), self.noun_before),
            (self.is_("subject_after"), self.own_last),
            (self.is_("modifier"), np.where(
                self.verb_after == NONE, self.own_last, np.where(after_sentence == self.own, self.verb_after, NONE))),
            (self.is_("later_sentence"), self._last_noun_of_first()),
        ], NONE)

    def subjects(self) -> tuple[np.ndarray, np.ndarray]:
        """Terms and the places of their subjects, in order."""
        low = np.where(self.anchor == NONE, 1, self.tokens.island[np.maximum(self.anchor, 0)])
        term, number = _ranges(np.arange(len(self.at)), low, np.where(self.anchor == NONE, 0, self.anchor))
        places = self.tokens.noun_at[number]
        alone = np.flatnonzero(self.is_("noun_alone"))
        return _by_term([(term, places), (alone, self.at[alone])])

    def rows(self, subjects: np.ndarray, predicates: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Order of the terms, and the number of the row of each term in this order, from the numbers of subjects
        and predicates of each: a row per review, or several where its reasons would hold too many subjects.

        Terms that may have the same subjects stand in one row: those of one anchor, and those without subjects.
        """
        size = (1 + subjects) * np.maximum(predicates, 1)
        order = np.arange(len(self.at))
        large = np.bincount(self.review, size)[self.review] > ROW_SUBJECTS
        alone = self.is_("noun_alone")
        group = np.where(alone, np.where(self.tokens.is_noun[self.at], self.nth, -1 - self.at), self.anchor)
        part = np.zeros(len(order), np.int64)
        if large.any():
            order = np.lexsort((np.where(large, group, 0), self.review))
            held = np.cumsum(size[order])
            begins = np.ones(len(order), bool)
            begins[1:] = (np.diff(group[order]) != 0) | (np.diff(self.review[order]) != 0)
            # a group goes where it begins
            part = np.where(large[order], held[begins][np.cumsum(begins) - 1] // ROW_SUBJECTS, 0)
        new = (np.diff(self.review[order], prepend=NONE) != 0) | (np.diff(part, prepend=0) != 0)
        return order, np.cumsum(new) - 1

    def predicates(self) -> tuple[np.ndarray, np.ndarray]:
        """Terms and the places of their predicates in the order of the walk, the first of each lemma.

        A walk consists of ranges of verb numbers. Within one, and between neighbouring ranges, a verb is
        the first of its lemma if the pointer to its neighbour leads out of what was walked.
        """
        sizes = np.cumsum(self.last_verb - self.first_verb + 2)
        cuts = np.searchsorted(sizes, np.arange(WALKED, sizes[-1] if len(sizes) else 0, WALKED), "left")
        parts = []
        for some in np.split(np.arange(len(self.at)), np.unique(cuts)):
            if len(some):
                parts += self._walks(some)
        # a term may be a predicate itself, before or after what was walked
        ahead, behind = np.flatnonzero(self.is_("noun_as_predicate")), np.flatnonzero(self.is_("modifier"))
        walked = [(term, self.tokens.verb_at[number]) for term, number in parts]
        return _by_term([(ahead, self.at[ahead]), *walked, (behind, self.at[behind])])

    def _walks(self, some: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Terms and verb numbers; ranges of one term follow each other."""
        k, found = self.tokens, []

        def of(*names: str) -> np.ndarray:
            return some[self.is_(*names)[some]]

        def down(terms: np.ndarray, high: np.ndarray, low: np.ndarray, kept: Callable) -> None:
            """Verbs kept of those from ``high`` back to ``low``; ``kept`` takes places in ``terms`` and verbs."""
            i, number = _ranges(np.arange(len(terms)), low, high, down=True)
            keep = kept(i, number)
            found.append((terms[i[keep]], number[keep]))

        def up(terms: np.ndarray, low: np.ndarray, high: np.ndarray, kept: Callable) -> None:
            i, number = _ranges(np.arange(len(terms)), low, high)
            keep = kept(i, number)
            found.append((terms[i[keep]], number[keep]))

        def own_sentence(terms: np.ndarray, low: np.ndarray, high: np.ndarray) -> None:
            """From the term back to ``low``, then on to ``high``."""
            upto = self.upto[terms]
            down(terms, upto, low, lambda i, v: k.after[v] > upto[i])
            up(terms, upto + 1, high, lambda i, v: k.before[v] < low[i])

        def ahead(terms: np.ndarray, noun: np.ndarray) -> None:
            upto = self.upto[terms]
            high = np.minimum(self.end[terms], k.gap_end(noun, self.review[terms]))
            up(terms, upto + 1, high, lambda i, v: k.before[v] <= upto[i])

        def near(terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """The gap of the term and that of the verb before it, or else after it."""
            before, after, review = self.verb_before[terms], self.verb_after[terms], self.review[terms]
            low = np.where(
                before != NONE, np.maximum(self.start[terms] + 1, k.gap_start(before, review)), self.upto[terms] + 1)
            noun = np.where((before != NONE) | (after == NONE), self.nth[terms], after)
            return low, np.minimum(self.end[terms], k.gap_end(noun, review))

        def gap_of_last(terms: np.ndarray, sentence: np.ndarray) -> None:
            """The gap of the last verb of another sentence."""
            low, high = k.verbs[sentence], k.verbs[k.own_stop[sentence]]
            gap = np.maximum(low + 1, k.gap_start(k.noun_after(high), self.review[terms]))
            down(terms, np.where(high > low, high, gap - 1), gap, lambda i, v: k.after[v] > high[i])

        def all_upto(terms: np.ndarray, last: np.ndarray) -> None:
            """Own sentence, sentences before it backward, sentences after it forward, each from its end."""
            start, end = self.start[terms], self.end[terms]
            own_sentence(terms, start + 1, end)
            down(terms, start, self.first_verb[terms], lambda i, v: k.after[v] > end[i])
            up(terms, end + 1, last, lambda i, v: k.fresh[v] & (k.final[v] == v))
            later, number = found.pop()
            order = np.lexsort((-number, k.own_start[k.verb_at[number]], later))
            found.append((later[order], number[order]))

        terms = of("noun_then_predicate")
        ahead(terms, self.nth[terms])
        terms = of("modifier")
        terms = terms[self.verb_after[terms] != NONE]
        ahead(terms, self.verb_after[terms])

        terms = of("subject_before")
        own_sentence(terms, *near(terms))

        terms = of("noun_as_predicate")
        noun, review, lemma = self.noun_before[terms], self.review[terms], k.lemma[self.at[terms]]
        low = np.maximum(self.start[terms] + 1, k.gap_start(noun, review))
        high = np.minimum(self.upto[terms], k.gap_end(noun, review))
        down(terms, high, low, lambda i, v: (
            (k.after[v] > high[i]) & (k.lemma[k.verb_at[v]] != lemma[i]) & (lemma[i] != NONE)))

        # what follows the own sentence's last noun, from its end, but for lemmas already found
        terms = of("subject_after")
        gap = near(terms)
        own_sentence(terms, *gap)
        held = np.concatenate([k.final[number] + t * len(k.after) for t, number in found[-2:]])
        rest = np.maximum(k.gap_start(self.own_last[terms], self.review[terms]), gap[1] + 1)
        down(terms, self.end[terms], rest, lambda i, v: (
            (k.final[v] == v) & ~np.isin(v + terms[i] * len(k.after), held)))

        # through the own sentence, then back to the noun before
        terms = of("earlier_sentence")
        low = k.gap_start(self.nth[terms], self.review[terms])
        high = np.minimum(k.gap_end(self.nth[terms], self.review[terms]), self.end[terms])
        here = low <= high
        gap_of_last(terms[~here], self.near[terms[~here]])
        terms, low, high = terms[here], low[here], high[here]
        own_sentence(terms, np.maximum(low, self.start[terms] + 1), high)
        down(terms, self.start[terms], low, lambda i, v: k.after[v] > high[i])

        # everything before the sentence of the first noun, then what follows that sentence's nouns
        terms = of("later_sentence")
        before = k.verbs[self.first[terms]] >= self.first_verb[terms]
        gap_of_last(terms[~before], self.first[terms[~before]])
        terms = terms[before]
        first = self.first[terms]
        low, high = k.verbs[first], k.verbs[k.own_stop[first]]
        all_upto(terms, low)
        anchor_gap = np.maximum(low + 1, k.gap_start(self._last_noun_of_first()[terms], self.review[terms]))
        down(terms, high, anchor_gap, lambda i, v: k.fresh[v] & (k.final[v] == v))

        terms = of("no_subject")
        all_upto(terms, self.last_verb[terms])
        return found


def _ranges(names: np.ndarray, low: np.ndarray, high: np.ndarray, down: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """All numbers from ``low`` to ``high``, or the other way, with the name of their range."""
    sizes = np.maximum(high - low + 1, 0)
    step = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return np.repeat(names, sizes), np.repeat(high, sizes) - step if down else np.repeat(low, sizes) + step


def _by_term(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Parts put together by term; what belongs to one term stays in order."""
    terms = np.concatenate([t for t, _ in parts])
    order = np.argsort(terms, kind="stable")
    return terms[order], np.concatenate([p for _, p in parts])[order]


_SUBJECT = pa.struct([("index", pa.int32()), ("lemma", pa.string()), ("entity", pa.string())])
_PREDICATE = pa.struct([("index", pa.int32()), ("lemma", pa.string()), ("issue_category", pa.string())])
_PAIR = pa.struct([
    ("term_index", pa.int32()), ("term", pa.string()), ("polarities", pa.list_(pa.string())), ("rule", pa.string()),
    ("subjects", pa.list_(_SUBJECT)), ("predicates", pa.list_(_PREDICATE))])
REVIEW_PAIRS = pa.schema([
    ("run_id", pa.string()), ("review_id", pa.string()), ("row_id", pa.string()), ("pairs", pa.list_(_PAIR))])


def _lists(owners: np.ndarray, size: int, values: pa.Array) -> pa.ListArray:
    """A list for each of ``size`` owners, of the values that stand by owner."""
    offsets = np.concatenate(([0], np.cumsum(np.bincount(owners, minlength=size))))
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), values)


def _pairs_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs of a partition's reviews, mostly a row per review with a term."""
    found = blocks.read(batches, "row_id", ["sentence", "place"])
    if found is None:
        return
    column = {name: found.rows.column(name) for name in found.rows.column_names}
    codes, lemmas = blocks.encoded(column["lemma"])
    codes = np.where(lemmas.is_valid().to_numpy(zero_copy_only=False)[codes], codes, NONE)
    is_term = column["polarities"].is_valid().to_numpy()
    shown, sentence = column["shown"].to_numpy(), column["sentence"].to_numpy()

    def words(places: np.ndarray, kind: pa.StructType, index: np.ndarray, low: int) -> pa.StructArray:
        tags = [blocks.taken(column[name], places + low) for name in ("lemma", kind[2].name)]
        return pa.StructArray.from_arrays([pa.array(index[places]), *tags], fields=list(kind))

    for first, last in found.blocks():
        low, high = int(found.starts[first]), int(found.starts[last])
        at = np.flatnonzero(is_term[low:high])
        if not len(at):
            continue
        starts = found.starts[first:last] - low
        tokens = _Tokens(shown[low:high], sentence[low:high], codes[low:high], starts)
        terms = _Terms(tokens, at)
        index = (np.arange(high - low) - starts[tokens.review]).astype(np.int32)
        of_subjects, places = terms.subjects()
        subjects = _lists(of_subjects, len(at), words(places, _SUBJECT, index, low))
        of_predicates, places = terms.predicates()
        predicates = _lists(of_predicates, len(at), words(places, _PREDICATE, index, low))
        term, polarities = (blocks.taken(column[name], at + low) for name in ("lemma", "polarities"))
        pairs = pa.StructArray.from_arrays([
            pa.array(index[at]), term, polarities.cast(_PAIR[2].type),
            pa.array(_RULES, pa.string()).take(pa.array(terms.rule)), subjects, predicates], fields=list(_PAIR))
        order, row = terms.rows(*(np.bincount(owners, minlength=len(at)) for owners in (of_subjects, of_predicates)))
        if (np.diff(order) != 1).any():
            pairs = pairs.take(pa.array(order))
        new = order[np.flatnonzero(np.diff(row, prepend=NONE))]  # a term of each row
        out = {name: blocks.taken(column[name], at[new] + low) for name in ("run_id", "review_id")}
        out["row_id"] = found.names.take(pa.array(first + terms.review[new]))
        yield from blocks.batches_of(out | {"pairs": _lists(row, len(new), pairs)}, REVIEW_PAIRS)


def review_pairs(tokens: DataFrame, rules: TokenRules = JAPANESE_RULES) -> DataFrame:
    """One row per review with a polarity term: ``pairs`` holds, for each term, its rule and its
    ``subjects`` and ``predicates`` as arrays of tagged words. Every term of a long sentence holds its subjects,
    so a review of very many gets several rows (see ``ROW_SUBJECTS``), with terms of equal subjects in one.

    ``tokens`` holds kept words with ``sentence`` (from 0 or 1, ascending) and ``place`` and the tags
    ``polarities``, ``entity`` and ``issue_category``. Empty arrays mean none was found.
    """
    roles = assign_roles(tokens, rules).withColumns({
        "noun": F.col("pos") == rules.noun, "adjective": F.col("pos") == rules.adjective,
        "adjectival_noun": F.col("pos") == rules.adjectival_noun, "auxiliary": F.col("pos") == rules.auxiliary,
    })
    shown = role_of({role: F.lit(number) for role, number in _ROLES.items()})
    for name, bit in _FLAGS.items():
        shown = shown + F.when(F.col(name), bit).otherwise(0)
    is_term = F.col("polarities").isNotNull()
    # words without a role are counted only, and a review without a term has no pairs
    named = is_term | F.col("is_subject") | F.col("is_predicate")
    rows = roles.select(
        "row_id", *[F.when(is_term, F.col(k)).alias(k) for k in ("run_id", "review_id")],
        F.col("sentence").cast("long").alias("sentence"), F.col("place").cast("long").alias("place"), shown.alias("shown"),
        *[F.when(named, F.col(c)).alias(c) for c in ("lemma", "entity", "issue_category")], "polarities")
    return blocks.together(rows, "row_id").mapInArrow(_pairs_of, from_arrow_schema(REVIEW_PAIRS))


def explode_pairs(reviews: DataFrame) -> DataFrame:
    """One row per polarity term."""
    # the outer form, as the inner one would have the optimiser build the pairs twice to skip empty arrays
    rows = reviews.select("run_id", "review_id", "row_id", F.explode_outer("pairs").alias("pair"))
    return rows.select("run_id", "review_id", "row_id", "pair.*")


def extract_pairs(tokens: DataFrame, rules: TokenRules = JAPANESE_RULES) -> DataFrame:
    """One row per polarity term: ``term_index``, ``term``, ``polarities``, ``rule``, ``subjects``,
    ``predicates``; see :func:`review_pairs`."""
    return explode_pairs(review_pairs(tokens, rules))
