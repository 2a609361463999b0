"""DuckDB statements that state each query's result independently of the Spark plans.

The relations are common table expressions over the given tables; extraction is stated as the walks
over tokens that the Spark plan avoids. Timestamps, dates and arrays are rendered as text and
fractions rounded, as in the registered queries.
"""

from __future__ import annotations

from reviewloom import schemas as S
from reviewloom.functions import ids
from reviewloom.functions import text as X
from reviewloom.operators.extract import SPACED_RULES as RULES
from reviewloom.operators.tokens import KEPT_POS
from reviewloom.sources import driver_tables as D


def q(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def among(values) -> str:
    return "(" + ", ".join(q(v) for v in values) + ")"


def case(digit: str, mapping: dict[str, str]) -> str:
    return f"CASE {digit} " + " ".join(f"WHEN {q(k)} THEN {v}" for k, v in mapping.items()) + " END"


def uuid5(name: str) -> str:
    digest = f"sha1(unhex('{ids.DEFAULT_NAMESPACE.replace('-', '')}') || encode({name}))"
    variant = f"translate(substr({digest}, 17, 1), '0123456789abcdef', '89ab89ab89ab89ab')"
    return (
        f"(substr({digest}, 1, 8) || '-' || substr({digest}, 9, 4) || '-5' || substr({digest}, 14, 3) || '-' || "
        f"{variant} || substr({digest}, 18, 3) || '-' || substr({digest}, 21, 12))"
    )


def chain(text: str, patterns) -> str:
    for p in patterns:
        text = f"regexp_replace({text}, {q(p)}, '|', 'g')"
    return text


SPACE = "[\\s\\x{1c}-\\x{1f}\\x{0b}\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]"


def strip(text: str) -> str:
    return f"regexp_replace({text}, '^{SPACE}+|{SPACE}+$', '', 'g')"


# The sentence ends as one pattern each, replaced in this order.
DEFAULT_DELIMITERS = [
    "!+", "\\?+", "。+", "、、+", "\\.\\.\\.+", "・・・+", "…+", "[\\(\\)]", "wwww+", SPACE + "+", "\\#+",
    f"[{X.FACES}]", f"[{X.GESTURES}]", "\\|+",
]
SPACED_DELIMITERS = ["[.!?…]+", "[()\\[\\]{}]", "\\#+", "\\|+"]


def ts(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S.%g')"


def day(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d')"


def rate(part: str, whole: str) -> str:
    return f"round(CASE WHEN {whole} = 0 THEN NULL ELSE ({part})::DOUBLE / {whole} END, 6)"


def words(text: str) -> str:
    return f"regexp_extract_all({text}, '[\\p{{L}}\\p{{N}}]+')"


_GOOD, _BAD = (
    case("substr(h, 5, 1)", {k: f"replace(replace({q(v)}, '{{d}}', dd), '{{h}}', hh)" for k, v in forms.items()})
    for forms in (D.POSTED_FORMS, D.BAD_FORMS)
)
_POSTED = f"CASE WHEN substr(h, 12, 2) < '04' THEN {_BAD} ELSE {_GOOD} END"
_PATH = "'documents_' || lang || '.csv/' || lpad(doc_id::VARCHAR, 20, '0')"
_HEX = "'0123456789abcdef'"


def dictionary(classes) -> str:
    rows = ", ".join(f"({q(d)}, {q(p)}, {q(s)}, {q(i)}, {q(m)})" for d, (p, s, i, m) in classes.items())
    return f"""
  SELECT w.term AS surface, c.pos, c.sub_pos, c.inflection, CASE WHEN c.lemma = '' THEN w.term ELSE c.lemma END AS lemma
  FROM (SELECT DISTINCT term FROM vocabulary) w
  JOIN (VALUES {rows}) c(digit, pos, sub_pos, inflection, lemma) ON c.digit = substr(md5(w.term), 1, 1)"""


def _category(names, position: int) -> str:
    digit = f"substr(md5(concat_ws('|', term, substr(md5(item_id::VARCHAR), 1, 1))), {position}, 1)"
    return case(digit, {_HEX[1:-1][i]: q(n) for i, n in enumerate(names)})


def tokens_of(source: str, delimiters) -> str:
    cut = chain("review_text", delimiters)
    return f"""
  SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY sentence, place) - 1 AS idx,
         row_number() OVER (PARTITION BY row_id, sentence ORDER BY place) - 1 AS idx_in_sentence
  FROM (
    SELECT s.run_id, s.row_id, s.review_id, s.sentence, s.place, s.surface,
           coalesce(m.pos, {q(D.UNKNOWN.pos)}) AS pos, coalesce(m.sub_pos, {q(D.UNKNOWN.sub_pos)}) AS sub_pos,
           coalesce(m.inflection, {q(D.UNKNOWN.inflection)}) AS inflection, coalesce(m.lemma, s.surface) AS lemma
    FROM (
      SELECT run_id, row_id, review_id, sentence, unnest({words('txt')}) AS surface,
             generate_subscripts({words('txt')}, 1) - 1 AS place
      FROM (
        SELECT run_id, row_id, review_id, unnest(parts) AS txt, generate_subscripts(parts, 1) AS sentence
        FROM (SELECT run_id, row_id, review_id,
                     string_split(lower(translate({cut}, {q(X._FULLWIDTH)}, {q(X._HALFWIDTH)})), '|') AS parts
              FROM {source})
      ) WHERE txt <> ''
    ) s LEFT JOIN morphs m ON m.surface = s.surface
  ) WHERE pos IN {among(KEPT_POS)}"""


CTE: dict[str, str] = {
    "lines": """
  SELECT doc_id, lang, source, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_pos,
         CASE WHEN substr(md5(doc_id::VARCHAR), 1, 1) < '4' THEN ['run_a', 'run_b'] ELSE ['run_a'] END AS runs
  FROM documents""",
    "raw": f"""
  SELECT CASE WHEN substr(h, 1, 2) < '02' THEN '' ELSE source END AS source,
         CASE WHEN substr(h, 1, 2) BETWEEN '02' AND '04' THEN NULL ELSE md5(line) END AS source_id,
         CASE WHEN substr(h, 3, 2) < '02' THEN NULL WHEN substr(h, 3, 2) < '04' THEN '　 ' || chr(9) ELSE line END AS review_text,
         {_POSTED} AS posted_at,
         'user_' || substr(h, 8, 4) AS user_name,
         'documents_' || lang || '.csv' AS source_file,
         {_PATH} AS source_path, line_pos + 1 AS row_number,
         md5(concat_ws('|', run_id, {_PATH}, line_pos + 1)) AS row_id,
         CASE WHEN run_id = 'run_a' THEN TIMESTAMP '2024-03-01' ELSE TIMESTAMP '2024-03-02' END AS ingested_at,
         run_id, doc_id
  FROM (
    SELECT *, lpad((instr({_HEX}, substr(h, 6, 1)) + 5)::VARCHAR, 2, '0') AS dd,
           lpad((instr({_HEX}, substr(h, 7, 1)) + 3)::VARCHAR, 2, '0') AS hh
    FROM (SELECT doc_id, lang, source, line, line_pos, unnest(runs) AS run_id,
                 md5(concat_ws('|', doc_id, line_pos)) AS h FROM lines))""",
    "standard": f"""
  SELECT *, CASE WHEN coalesce(source, '') <> '' AND coalesce(source_id, '') <> ''
                 THEN {uuid5("source || '|' || source_id")} END AS review_id,
         coalesce(
           try_strptime(trim(posted_at), ['%Y/%m/%d %H:%M', '%B %d, %Y', '%m/%d/%Y %I:%M %p', '%Y-%m-%dT%H', '%a, %d %b %Y %H:%M:%S GMT', '%Y%m%d%H%M%S',
                   '%b %d %Y', '%Y-%m-%d', '%Y-%m-%d %H:%M:%S', '%m/%d/%Y', '%d/%m/%Y', '%Y%m%d']),
           CASE WHEN regexp_matches(posted_at, '[T ].*(Z|[+-]\\d\\d(:\\d\\d)?)$')
                THEN try_cast(posted_at AS TIMESTAMPTZ) AT TIME ZONE 'UTC' END) AS posted_at_iso,
         {strip('review_text')} AS stripped,
         row_number() OVER (PARTITION BY run_id, source, source_id ORDER BY source_path, row_number) AS occurrence
  FROM raw""",
    "validated": f"""
  SELECT *, len(invalid_reason) = 0 AS is_valid FROM (
    SELECT *, list_sort([x FOR x IN [
      CASE WHEN review_id IS NULL THEN {q(S.MISSING_ID)} WHEN occurrence > 1 THEN {q(S.DUPLICATE)} END,
      CASE WHEN review_text IS NULL THEN {q(S.TEXT_NOT_STRING)} WHEN stripped = '' THEN {q(S.TEXT_EMPTY)}
           WHEN length(stripped) > 500 THEN {q(S.TEXT_TOO_LONG)} WHEN length(stripped) < 5 THEN {q(S.TEXT_TOO_SHORT)} END,
      CASE WHEN trim(coalesce(posted_at, '')) = '' THEN {q(S.POSTED_MISSING)}
           WHEN posted_at_iso IS NULL THEN {q(S.POSTED_PARSE_FAILED)} END
    ] IF x IS NOT NULL]) AS invalid_reason FROM standard)""",
    "dedup": """
  SELECT * FROM validated WHERE review_id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY review_id ORDER BY ingested_at DESC, row_id DESC) = 1
  UNION ALL SELECT * FROM validated WHERE review_id IS NULL""",
    "vocabulary": f"""
  SELECT item_id, unnest({words('lower(text)')}) AS term, generate_subscripts({words('lower(text)')}, 1) - 1 AS pos
  FROM benchmark""",
    "morphs": dictionary(D.MORPH_CLASSES),
    "sentiments": """
  SELECT DISTINCT term, 'negative' AS polarity FROM vocabulary WHERE substr(md5(term), 2, 1) IN ('0', '2')
  UNION ALL SELECT DISTINCT term, 'positive' FROM vocabulary WHERE substr(md5(term), 2, 1) IN ('1', '2')""",
    "entities": f"""
  SELECT term, entity FROM (SELECT term, item_id, pos, {_category(D.ENTITIES, 3)} AS entity FROM vocabulary)
  WHERE entity IS NOT NULL QUALIFY row_number() OVER (PARTITION BY term ORDER BY item_id, pos) = 1""",
    "issues": f"""
  SELECT term, issue_category FROM (SELECT term, item_id, pos, {_category(D.ISSUES, 4)} AS issue_category FROM vocabulary)
  WHERE issue_category IS NOT NULL QUALIFY row_number() OVER (PARTITION BY term ORDER BY item_id, pos) = 1""",
    "synonyms": """
  SELECT m.lemma, m.pos, 'syn_' || v.item_id || '_' || v.pos AS synonym
  FROM vocabulary v JOIN morphs m ON m.surface = v.term WHERE substr(md5(v.term), 5, 1) < '8'
  QUALIFY row_number() OVER (PARTITION BY m.lemma, m.pos ORDER BY v.item_id DESC, v.pos DESC) = 1""",
    # the text queries read reviews of any length
    "valid": f"SELECT * FROM validated WHERE len([x FOR x IN invalid_reason IF x <> {q(S.TEXT_TOO_LONG)}]) = 0",
    "tokens": tokens_of("valid", SPACED_DELIMITERS),
    "roles": f"""
  SELECT *, pos = {q(RULES.noun)} AND sub_pos NOT IN {among(RULES.no_subject)} AND lemma NOT IN {among(RULES.no_subject_lemmas)} AS en,
         pos = {q(RULES.noun)} AND sub_pos IN {among(RULES.no_subject)} AND lemma NOT IN {among(RULES.transparent_nouns)} AS blocker,
         pos IN {among(RULES.predicates)} AS verbal,
         pos IN {among(RULES.predicates)} AND sub_pos NOT IN {among(RULES.no_predicate)}
           AND lemma NOT IN {among(RULES.no_predicate_lemmas)} AS pred,
         (pos = {q(RULES.particle)} AND lemma IN {among(RULES.linking_particles)})
           OR (pos = {q(RULES.auxiliary)} AND inflection = {q(RULES.conditional)}) AS link
  FROM tokens""",
    "terms": f"""
  SELECT r.row_id, r.run_id, r.review_id, r.idx AS p, r.sentence AS n, r.lemma AS term, r.en AS term_en,
         CASE WHEN r.pos = {q(RULES.noun)} THEN 'noun'
              WHEN r.pos = {q(RULES.adjective)} AND (
                     (a.pos = {q(RULES.noun)} AND a.sub_pos NOT IN {among(RULES.not_modified)})
                  OR (a.pos = {q(RULES.auxiliary)} AND b.pos = {q(RULES.noun)} AND b.sub_pos NOT IN {among(RULES.not_modified)}))
                THEN 'modifier'
              WHEN r.pos = {q(RULES.adjectival_noun)} AND b.pos = {q(RULES.noun)} AND b.sub_pos NOT IN {among(RULES.not_modified)} AND (
                     (a.pos = {q(RULES.auxiliary)} AND a.lemma IN {among(RULES.adnominal_auxiliaries)} AND a.inflection = {q(RULES.adnominal_inflection)})
                  OR (a.pos = {q(RULES.particle)} AND a.lemma IN {among(RULES.adnominal_particles)}))
                THEN 'modifier'
              WHEN r.verbal THEN 'verbal' ELSE 'other' END AS kind
  FROM roles r
  LEFT JOIN roles a ON a.row_id = r.row_id AND a.sentence = r.sentence AND a.idx = r.idx + 1
  LEFT JOIN roles b ON b.row_id = r.row_id AND b.sentence = r.sentence AND b.idx = r.idx + 2
  WHERE r.lemma IN (SELECT term FROM sentiments)""",
    "facts": """
  SELECT t.row_id, t.p,
         max(r.idx) FILTER (r.sentence = t.n) AS own_end,
         coalesce(bool_or(r.en AND r.sentence = t.n AND r.idx <= t.p), false) AS noun_upto,
         coalesce(bool_or(r.en AND r.sentence = t.n AND r.idx < t.p), false) AS noun_before,
         coalesce(bool_or(r.en AND r.sentence = t.n), false) AS noun_own,
         max(r.sentence) FILTER (r.en AND r.sentence < t.n) AS earlier,
         min(r.sentence) FILTER (r.en AND r.sentence > t.n) AS later,
         min(r.idx) FILTER (r.en AND r.sentence = t.n AND r.idx > t.p) AS next_noun,
         min(r.idx) FILTER (r.pred AND r.sentence = t.n AND r.idx > t.p) AS next_pred
  FROM terms t JOIN roles r USING (row_id) GROUP BY ALL""",
    "cases": """
  SELECT t.*, f.* EXCLUDE (row_id, p),
         CASE WHEN kind = 'noun' THEN
                CASE WHEN next_pred IS NOT NULL AND (next_noun IS NULL OR next_pred < next_noun) THEN 'noun_then_predicate'
                     WHEN noun_before THEN 'noun_as_predicate' ELSE 'noun_alone' END
              WHEN kind IN ('modifier', 'other') THEN kind
              WHEN noun_upto THEN 'subject_before' WHEN noun_own THEN 'subject_after'
              WHEN earlier IS NOT NULL THEN 'earlier_sentence' WHEN later IS NOT NULL THEN 'later_sentence'
              ELSE 'no_subject' END AS rule
  FROM terms t JOIN facts f USING (row_id, p)""",
    "walks": """
  SELECT row_id, p, 1 AS walk, -idx AS step, idx, lemma, pred, en, false AS held
  FROM cases JOIN roles USING (row_id) WHERE kind = 'verbal' AND sentence = n AND idx <= p
  UNION ALL
  SELECT row_id, p, 2, idx, idx, lemma, pred, en, kind = 'noun'
  FROM cases JOIN roles USING (row_id) WHERE sentence = n AND (
    (kind = 'verbal' AND idx >= p) OR (rule IN ('noun_then_predicate', 'modifier') AND idx > p))
  UNION ALL
  SELECT row_id, p, 2, -idx, idx, lemma, pred, en, true
  FROM cases JOIN roles USING (row_id) WHERE rule = 'noun_as_predicate' AND sentence = n AND idx < p
  UNION ALL
  SELECT row_id, p, 3, -idx, idx, lemma, pred, en, false
  FROM cases JOIN roles USING (row_id)
  WHERE (rule = 'subject_after' AND sentence = n)
     OR (rule = 'earlier_sentence' AND sentence >= earlier AND sentence < n)
     OR (rule IN ('later_sentence', 'no_subject') AND sentence < n)
  UNION ALL
  SELECT row_id, p, 3 + sentence - n, -idx, idx, lemma, pred, en, false
  FROM cases JOIN roles USING (row_id)
  WHERE (rule = 'later_sentence' AND sentence > n AND sentence <= later) OR (rule = 'no_subject' AND sentence > n)""",
    "picked": """
  SELECT row_id, p, idx, lemma FROM (
    SELECT *, min(step) FILTER (en AND (held OR coalesce(seen, 0) > 0)) OVER (PARTITION BY row_id, p, walk) AS cut
    FROM (SELECT *, sum(pred::INT) OVER (PARTITION BY row_id, p ORDER BY walk, step
                                         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM walks))
  WHERE pred AND (cut IS NULL OR step < cut)
  QUALIFY row_number() OVER (PARTITION BY row_id, p, lemma ORDER BY walk, step) = 1""",
    "predicates": """
  SELECT k.row_id, k.p, k.idx, k.lemma FROM picked k JOIN cases c USING (row_id, p)
  WHERE c.rule <> 'noun_as_predicate' OR k.lemma <> c.term
  UNION ALL SELECT row_id, p, p, term FROM cases WHERE rule IN ('noun_as_predicate', 'modifier')""",
    "subject_start": """
  SELECT row_id, p,
         CASE rule WHEN 'earlier_sentence' THEN earlier WHEN 'later_sentence' THEN later ELSE n END AS s,
         CASE WHEN rule IN ('noun_then_predicate', 'subject_before') THEN p WHEN rule = 'noun_as_predicate' THEN p - 1
              WHEN rule = 'modifier' AND next_pred IS NOT NULL THEN next_pred ELSE 1000000000 END AS upto
  FROM cases WHERE rule NOT IN ('noun_alone', 'no_subject', 'other')""",
    "subjects": """
  SELECT row_id, p, idx, lemma FROM (
    SELECT *, max(idx) FILTER (verbal AND nouns > 0 AND coalesce(flag, 0) = 0) OVER (PARTITION BY row_id, p) AS stop FROM (
      SELECT a.row_id, a.p, r.idx, r.lemma, r.en, r.verbal,
             sum(r.en::INT) OVER w AS nouns,
             last_value(CASE WHEN r.en OR r.blocker THEN 0 WHEN r.link THEN 1 END IGNORE NULLS) OVER w AS flag
      FROM subject_start a JOIN roles r ON r.row_id = a.row_id AND r.sentence = a.s AND r.idx <= a.upto
      WINDOW w AS (PARTITION BY a.row_id, a.p ORDER BY r.idx DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)))
  WHERE en AND (stop IS NULL OR idx > stop)
  UNION ALL SELECT row_id, p, p, term FROM cases WHERE rule = 'noun_alone'""",
    "subject_lists": """
  SELECT s.row_id, s.p, list(s.idx ORDER BY s.idx) AS subject_idx, list(s.lemma ORDER BY s.idx) AS subject,
         first(e.entity ORDER BY s.idx) FILTER (e.entity IS NOT NULL) AS entity
  FROM subjects s LEFT JOIN entities e ON e.term = s.lemma GROUP BY ALL""",
    "pairs": """
  SELECT DISTINCT c.run_id, c.review_id, c.row_id, x.polarity AS sentiment_type,
         coalesce(s.subject_idx, []) AS subject_idx, coalesce(s.subject, []) AS subject, s.entity,
         k.idx AS predicate_idx, k.lemma AS predicate
  FROM cases c JOIN sentiments x ON x.term = c.term
  LEFT JOIN subject_lists s USING (row_id, p) LEFT JOIN predicates k USING (row_id, p)""",
    "reasons": f"""
  SELECT sentiment_type, entity, issue_category,
         round(greatest(1.0::DOUBLE - CASE WHEN entity IS NULL THEN 0.2::DOUBLE ELSE 0 END
                        - CASE WHEN issue_category IS NULL THEN 0.2::DOUBLE ELSE 0 END
                        - CASE WHEN len(subject_idx) = 0 OR predicate_idx IS NULL THEN 0.3::DOUBLE
                               ELSE 0.03::DOUBLE * (list_min([abs(i - predicate_idx) FOR i IN subject_idx]) - 1) END, 0), 2) AS confidence,
         subject, predicate, review_id,
         {uuid5("concat_ws('|', run_id, row_id, array_to_string(subject_idx, ','), coalesce(predicate_idx::VARCHAR, ''), sentiment_type)")} AS reason_id,
         run_id
  FROM pairs p LEFT JOIN issues i ON i.term = p.predicate""",
    "joined": """
  SELECT r.*, d.source_file, d.source, d.posted_at_iso, d.posted_at_iso::DATE AS posted_date, d.ingested_at, d.review_text
  FROM reasons r JOIN dedup d ON d.review_id = r.review_id AND d.run_id = r.run_id WHERE d.is_valid""",
    "top1": """
  SELECT * FROM joined
  QUALIFY row_number() OVER (PARTITION BY run_id, review_id, sentiment_type ORDER BY confidence DESC, reason_id) = 1""",
}


def sql(select: str, extra: dict[str, str] | None = None) -> str:
    """A statement with the expressions ``select`` depends on, in order."""
    import re

    every = {**CTE, **(extra or {})}
    needed: set[str] = set()
    queue = [select]
    while queue:
        text = queue.pop()
        for name in every:
            if name not in needed and re.search(rf"\b(FROM|JOIN)\s+{name}\b", text):
                needed.add(name)
                queue.append(every[name])
    ctes = ",\n".join(f"{n} AS MATERIALIZED ({every[n]})" for n in every if n in needed)
    return (f"WITH {ctes}\n" if ctes else "") + select
