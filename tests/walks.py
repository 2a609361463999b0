"""Extraction by definition, for small reviews: every range is enumerated, nothing is precomputed.

A review is a list of token dicts in order; a result is (subject positions, predicate positions).
"""

from __future__ import annotations


def has_role(token, rules):
    noun = token["pos"] == rules.noun
    barred = token["sub_pos"] in rules.no_subject
    verbal = token["pos"] in rules.predicates
    return {
        "subject": noun and not barred and token["lemma"] not in rules.no_subject_lemmas,
        "blocker": noun and barred and token["lemma"] not in rules.transparent_nouns,
        "verbal": verbal,
        "predicate": verbal and token["sub_pos"] not in rules.no_predicate
        and token["lemma"] not in rules.no_predicate_lemmas,
        "link": (token["pos"] == rules.particle and token["lemma"] in rules.linking_particles)
        or (token["pos"] == rules.auxiliary and token["inflection"] == rules.conditional),
        "modifiable": noun and token["sub_pos"] not in rules.not_modified,
    }


class Review:
    def __init__(self, tokens, rules):
        self.tokens, self.rules = tokens, rules
        self.roles = [has_role(t, rules) for t in tokens]

    def is_(self, role, i):
        return self.roles[i][role]

    def positions(self, sentence):
        return [i for i, t in enumerate(self.tokens) if t["sentence"] == sentence]

    def subjects(self, scope):
        """Subject nouns of ``scope`` (ascending), seen from its end, up to the first closed clause."""
        nouns = [i for i in scope if self.is_("subject", i)]
        if not nouns:
            return []

        def closes(x):
            """A verbal word whose next noun or link, on the way to the last noun, is not a link."""
            ahead = [i for i in scope if x < i <= nouns[-1]
                     and (self.is_("subject", i) or self.is_("blocker", i) or self.is_("link", i))]
            return self.is_("verbal", x) and bool(ahead) and not self.is_("link", ahead[0])

        walls = [x for x in scope if x < nouns[-1] and closes(x)]
        return [i for i in nouns if not walls or i > walls[-1]]

    def predicates(self, walks, held=()):
        """Predicates along the walks in turn, one per lemma, each walk ending at a subject noun
        once any predicate is held."""
        lemmas, found, seen = set(held), [], bool(held)
        for walk in walks:
            for i in walk:
                if self.is_("subject", i) and seen:
                    break
                if self.is_("predicate", i):
                    seen = True
                    if self.tokens[i]["lemma"] not in lemmas:
                        lemmas.add(self.tokens[i]["lemma"])
                        found.append(i)
        return found

    def modifies(self, p, own):
        r = self.rules
        nxt = [i for i in own if i > p][:2]
        one = len(nxt) > 0 and self.is_("modifiable", nxt[0])
        two = len(nxt) > 1 and self.is_("modifiable", nxt[1])
        first = self.tokens[nxt[0]] if nxt else {"pos": "", "inflection": "", r.adnominal_field: ""}
        if self.tokens[p]["pos"] == r.adjective:
            return one or (two and first["pos"] == r.auxiliary)
        adnominal = (
            first["pos"] == r.auxiliary and first["inflection"] == r.adnominal_inflection
            and first[r.adnominal_field] in r.adnominal_auxiliaries
        ) or (first["pos"] == r.particle and first[r.adnominal_field] in r.adnominal_particles)
        return self.tokens[p]["pos"] == r.adjectival_noun and two and adnominal

    def pair(self, p):
        token = self.tokens[p]
        own = self.positions(token["sentence"])
        upto, after = [i for i in own if i <= p], [i for i in own if i > p]
        if token["pos"] == self.rules.noun:
            following = self.predicates([after], held=[object()])
            if following:
                return self.subjects(upto), following
            before = self.subjects(upto[:-1])
            if before:
                return before, [p] + self.predicates([upto[:-1][::-1]], held=[token["lemma"]])
            return [p], []
        if not self.is_("verbal", p):
            return [], []
        if self.modifies(p, own):
            following = self.predicates([after])
            scope = [i for i in own if i <= following[0]] if following else own
            return self.subjects(scope), following + [p]
        walks = [upto[::-1], [p] + after]
        if self.subjects(upto):
            return self.subjects(upto), self.predicates(walks)
        if self.subjects(own):
            return self.subjects(own), self.predicates(walks + [own[::-1]])
        numbers = sorted({t["sentence"] for t in self.tokens})
        for n in [n for n in numbers if n < token["sentence"]][::-1]:
            walks.append(self.positions(n)[::-1])
            if self.subjects(self.positions(n)):
                return self.subjects(self.positions(n)), self.predicates(walks)
        for n in [n for n in numbers if n > token["sentence"]]:
            walks.append(self.positions(n)[::-1])
            if self.subjects(self.positions(n)):
                return self.subjects(self.positions(n)), self.predicates(walks)
        return [], self.predicates(walks)
