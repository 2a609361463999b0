"""One DuckDB statement per registered query."""

from __future__ import annotations

from reviewloom import schemas as S
from reviewloom.functions import text as X
from reviewloom.operators import compounds as C
from reviewloom.sources import driver_tables as D
from verification.oracle import (
    DEFAULT_DELIMITERS, SPACED_DELIMITERS, among, case, chain, day, dictionary, q, rate, sql, tokens_of, ts,
)

K = 10
_HEX = "0123456789abcdef"

def joined(values: str, sep: str = ",") -> str:
    return f"array_to_string({values}, '{sep}')"


def has(message: str) -> str:
    return f"list_contains(invalid_reason, {q(message)})"


def count_if(condition: str) -> str:
    return f"count(*) FILTER ({condition})"


DAY_KEYS = "run_id, source_file, source, posted_date, sentiment_type"
DAY_OUT = f"run_id, source_file, source, {day('posted_date')} AS posted_date, sentiment_type"
AVG = "round(avg(confidence), 6) AS avg_confidence"


def kpi(extra: str, measures: str) -> str:
    return sql(f"SELECT {DAY_OUT}, {extra}, {measures}, {AVG} FROM top1 GROUP BY {DAY_KEYS}, {extra}")


def top(keys: str, source: str) -> str:
    return sql(f"SELECT {keys}, count(*) AS reason_count FROM {source} GROUP BY {keys} ORDER BY reason_count DESC, {keys} LIMIT {K}")


def pairs(*rules: str, extra: dict[str, str] | None = None) -> str:
    where = f"WHERE c.rule IN {among(rules)}" if rules else ""
    return sql(
        f"""SELECT c.row_id, c.p AS term_index, c.term, c.rule,
       coalesce({joined('s.subject_idx')}, '') AS subjects, coalesce({joined('k.idx')}, '') AS predicates
FROM cases c LEFT JOIN subject_lists s USING (row_id, p)
LEFT JOIN predicate_lists k USING (row_id, p) {where}""",
        {"predicate_lists": "SELECT row_id, p, list(idx ORDER BY idx) AS idx FROM predicates GROUP BY ALL", **(extra or {})},
    )


_DEFAULT_SPLIT = {"tokens": tokens_of("valid", DEFAULT_DELIMITERS)}


# --- compounds: the fold as a recursion over morpheme positions ----------------------------------


def _struct(**fields: str) -> str:
    names = ["surface", "pos", "sub_pos", "inflection", "lemma", "s", "e"]
    return "{" + ", ".join(f"'{n}': {fields[n]}" for n in names) + "}"


def _merged(base: str, **changes: str) -> str:
    fields = {n: f"{base}.{n}" for n in ["surface", "pos", "sub_pos", "inflection", "lemma", "s", "e"]}
    fields |= {"surface": f"{base}.surface || m.surface", "e": f"{base}.e + length(m.surface)"}
    return _struct(**(fields | changes))


_COMPOUND_RULES = [
    (f"m.pos = '動詞' AND m.sub_pos = '接尾' AND m.lemma IN {among(C.VOICE_SUFFIXES)} AND w.pos = '動詞' "
     f"AND w.inflection IN {among(C.VOICE_STEMS)}",
     1, _merged("w", lemma="w.surface || m.lemma", inflection="m.inflection")),
    (f"m.pos = '助動詞' AND m.lemma IN {among(C.NEGATIONS)} AND w.pos IN ('動詞', '形容詞') "
     f"AND w.inflection IN {among(C.AUXILIARY_STEMS)}",
     1, _merged("w", lemma="w.surface || 'ない'", inflection="'否定形'")),
    (f"m.pos = '助動詞' AND m.lemma = 'たい' AND w.pos IN ('動詞', '形容詞') AND w.inflection IN {among(C.AUXILIARY_STEMS)}",
     1, _merged("w", lemma="w.surface || 'たい'", inflection="'希望形'")),
    (f"m.pos = '動詞' AND m.sub_pos = '非自立' AND m.lemma IN {among(C.PROGRESSIVES)} AND w.pos = '動詞' "
     f"AND w.inflection IN {among(C.PROGRESSIVE_STEMS)}",
     1, _merged("w", inflection="m.inflection")),
    (f"m.pos = '助詞' AND m.sub_pos = '接続助詞' AND m.lemma = 'て' AND w.pos = '動詞' "
     f"AND w.inflection IN {among(C.CONJUNCTIVE_STEMS)}",
     1, _merged("w", inflection="w.inflection || '+接続助詞'")),
    (f"m.pos = '動詞' AND m.lemma IN {among(C.LIGHT_VERBS)} AND w.sub_pos = 'サ変接続'",
     1, _merged("w", pos="'動詞'", lemma="w.surface || m.lemma", inflection="m.inflection")),
    (f"m.pos = '動詞' AND m.lemma IN {among(C.LIGHT_VERBS)} AND w.pos = '助詞' AND v.sub_pos = 'サ変接続'",
     2, _merged("v", pos="'動詞'", lemma="v.lemma || m.lemma", inflection="m.inflection",
                e="v.e + length(w.surface) + length(m.surface)")),
]


def _compound_extra() -> dict[str, str]:
    normal = f"lower(translate({chain('review_text', SPACED_DELIMITERS)}, {q(X._FULLWIDTH)}, {q(X._HALFWIDTH)}))"
    found = f"regexp_extract_all({normal}, '[\\p{{L}}\\p{{N}}]+|\\|')"
    fresh = _struct(
        surface="m.surface", pos="m.pos", sub_pos="m.sub_pos", inflection="m.inflection", lemma="m.lemma",
        s="b", e="b + length(m.surface) - 1")
    steps = " ".join(
        f"WHEN {cond} THEN list_append(words[1:len(words) - {absorbs}], {word})" for cond, absorbs, word in _COMPOUND_RULES)
    merges = " OR ".join(f"({cond})" for cond, _, _ in _COMPOUND_RULES)
    kind = "STRUCT(surface VARCHAR, pos VARCHAR, sub_pos VARCHAR, inflection VARCHAR, lemma VARCHAR, s BIGINT, e BIGINT)"
    return {
        "compound_morphs": dictionary(D.COMPOUND_CLASSES),
        "morphemes": f"""
  SELECT s.row_id, s.place, s.surface, coalesce(d.pos, {q(D.UNKNOWN.pos)}) AS pos, coalesce(d.sub_pos, {q(D.UNKNOWN.sub_pos)}) AS sub_pos,
         coalesce(d.inflection, {q(D.UNKNOWN.inflection)}) AS inflection, coalesce(d.lemma, s.surface) AS lemma
  FROM (SELECT row_id, unnest({found}) AS surface, generate_subscripts({found}, 1) - 1 AS place FROM valid) s
  LEFT JOIN compound_morphs d ON d.surface = s.surface""",
        "folded": f"""
  WITH RECURSIVE fold AS (
    SELECT row_id, lower(review_text) AS txt, 0::BIGINT AS i, []::{kind}[] AS words, 0::BIGINT AS cur FROM valid
    UNION ALL
    SELECT row_id, txt, i + 1,
           CASE {steps} ELSE list_append(words, {fresh}) END::{kind}[],
           CASE WHEN {merges} THEN cur ELSE b + length(m.surface) END
    FROM (
      SELECT f.*, m, words[-1] AS w, words[-2] AS v,
             CASE WHEN instr(substr(txt, cur + 1), lower(m.surface)) > 0 THEN cur + instr(substr(txt, cur + 1), lower(m.surface)) - 1
                  ELSE coalesce(words[-1].e + 1, 0) END AS b
      FROM fold f JOIN morphemes m ON m.row_id = f.row_id AND m.place = f.i))
  SELECT row_id, words FROM fold QUALIFY row_number() OVER (PARTITION BY row_id ORDER BY i DESC) = 1""",
    }


def _heatmap() -> str:
    cells = ", ".join(f'{count_if(f"issue_category = {q(n)}")} AS "{n}"' for n in D.ISSUES)
    return sql(f"SELECT entity, {cells} FROM top1 GROUP BY entity")


_GOLD = {
    "gold": f"""
  SELECT d.run_id, d.review_id, l.quality = 1 AS is_correct,
         {case("substr(md5(l.doc_id::VARCHAR), 2, 1)", {_HEX[i]: q(n) for i, n in enumerate(D.ENTITIES)})} AS gold_entity,
         {case("substr(md5(l.doc_id::VARCHAR), 3, 1)", {_HEX[i]: q(n) for i, n in enumerate(D.ISSUES)})} AS gold_issue
  FROM dedup d JOIN labels l ON l.doc_id = d.doc_id WHERE d.is_valid""",
    "negative": "SELECT * FROM top1 WHERE sentiment_type = 'negative'",
    "judged": """
  SELECT g.*, t.reason_id, t.entity, t.issue_category
  FROM gold g LEFT JOIN negative t ON t.run_id = g.run_id AND t.review_id = g.review_id""",
}


def _label_quality(given: str, expected: str) -> str:
    return sql(
        f"""SELECT label, count(*) FILTER (expected = label) AS support, count(*) FILTER (given = label) AS predicted,
       round(CASE WHEN count(*) FILTER (given = label) > 0 THEN
         count(*) FILTER (given = label AND expected = label)::DOUBLE / count(*) FILTER (given = label) END, 6) AS label_precision,
       round(CASE WHEN count(*) FILTER (expected = label) > 0 THEN
         count(*) FILTER (given = label AND expected = label)::DOUBLE / count(*) FILTER (expected = label) END, 6) AS label_recall
FROM (SELECT given, expected, unnest(list_distinct([x FOR x IN [given, expected] IF x IS NOT NULL])) AS label
      FROM (SELECT {given} AS given, {expected} AS expected FROM judged)) GROUP BY label""", _GOLD)


def _coverage() -> str:
    whole = "v.valid_review_count"
    parts = [
        ("r.a", "reviews_with_any_reason", "extraction_coverage_any"),
        ("r.b", "reviews_with_negative_reason", "extraction_coverage_negative"),
        ("r.c", "entity_filled_count", "entity_coverage_negative"),
        ("r.d", "issue_category_filled_count", "issue_category_coverage_negative"),
    ]
    out = ", ".join(f"coalesce({c}, 0) AS {n}, {rate(f'coalesce({c}, 0)', whole)} AS {m}" for c, n, m in parts)
    return sql(f"""SELECT v.run_id, v.source_file, v.valid_review_count, {out} FROM (
  SELECT run_id, source_file, count(review_id) AS valid_review_count FROM dedup WHERE is_valid GROUP BY ALL) v
LEFT JOIN (
  SELECT run_id, source_file, count(DISTINCT review_id) AS a,
         count(DISTINCT CASE WHEN sentiment_type = 'negative' THEN review_id END) AS b,
         count(*) FILTER (entity IS NOT NULL AND sentiment_type = 'negative') AS c,
         count(*) FILTER (issue_category IS NOT NULL AND sentiment_type = 'negative') AS d
  FROM top1 GROUP BY ALL) r USING (run_id, source_file)""")


def _dq() -> str:
    failed, short, long, dup = (
        count_if(has(m)) for m in (S.POSTED_PARSE_FAILED, S.TEXT_TOO_SHORT, S.TEXT_TOO_LONG, S.DUPLICATE))
    return sql(f"""SELECT run_id, source_file, {ts('min(ingested_at)')} AS run_started_at, {ts('max(ingested_at)')} AS run_last_seen_at,
  count(*) AS total_rows, {count_if(f'NOT {has(S.DUPLICATE)} AND NOT {has(S.MISSING_ID)}')} AS unique_reviews,
  {count_if('is_valid')} AS rows_valid, {count_if('NOT is_valid')} AS rows_invalid, {rate(count_if('is_valid'), 'count(*)')} AS valid_rate,
  {count_if(has(S.MISSING_ID))} AS missing_source_or_source_id_rows, {count_if(has(S.TEXT_EMPTY))} AS missing_review_text_rows,
  {count_if(has(S.POSTED_MISSING))} AS missing_posted_at_rows, {failed} AS posted_at_parse_failed_rows,
  {rate(failed, 'count(*)')} AS posted_at_parse_failed_rate, {short} AS too_short_rows, {long} AS too_long_rows,
  {rate(f'{short} + {long}', 'count(*)')} AS length_out_of_range_rate, {dup} AS duplicate_rows, {rate(dup, 'count(*)')} AS duplicate_rate
FROM validated GROUP BY run_id, source_file""")


def orthography(text: str) -> str:
    """The spelling rules without look-around: spaces beside Japanese letters are removed by capture."""
    japanese, ascii_ = "[぀-ヿ一-鿿]", "[ -~]"
    for pattern, replacement in X.ORTHOGRAPHY:
        if pattern.startswith("(?<="):
            continue
        text = f"regexp_replace({text}, {q(pattern)}, {q(replacement)}, 'g')"
    return text


REASON_OUT = f"""sentiment_type, entity, issue_category, round(confidence, 6) AS confidence,
  {joined('subject')} AS subject, predicate, review_id, reason_id, run_id"""

STATEMENTS: dict[str, str] = {
    "ingest_metadata": sql(f"SELECT run_id, source_file, source_path, row_number, {ts('ingested_at')} AS ingested_at, row_id FROM raw"),
    "csv_scan": sql("""SELECT count(*) AS rows_read, count(*) AS rows_numbered, 0::BIGINT AS misnumbered_files,
  count(*) FILTER (source_id IS NULL) AS rows_without_source_id, sum(length(coalesce(review_text, '')))::BIGINT AS text_chars FROM raw"""),
    "raw_table": sql("SELECT run_id, row_id, source_path, row_number, source, source_id, md5(review_text) AS text_md5, posted_at, user_name FROM raw"),
    "validated_table_days": sql(f"""SELECT {day('posted_at_iso')} AS posted_date, count(*) AS rows_count, {count_if('is_valid')} AS valid_rows,
  min(review_id) AS first_review_id, max(review_id) AS last_review_id FROM validated GROUP BY 1"""),
    "reasons_table": sql(f"SELECT {REASON_OUT} FROM reasons"),
    "lexicon_entries": sql("""SELECT 'sentiment' AS kind, term, string_agg(polarity, ',' ORDER BY polarity) AS value FROM sentiments GROUP BY term
UNION ALL SELECT 'entity', term, entity FROM entities UNION ALL SELECT 'issue', term, issue_category FROM issues"""),
    "synonym_entries": sql("SELECT lemma, pos, synonym FROM synonyms"),
    "review_ids": sql("SELECT row_id, source, source_id, review_id FROM standard"),
    "posted_timestamps": sql(f"SELECT row_id, posted_at, {ts('posted_at_iso')} AS posted_at_iso, {day('posted_at_iso')} AS posted_date FROM standard"),
    "validation_flags": sql(f"SELECT row_id, review_id, is_valid, {joined('invalid_reason')} AS invalid_reason FROM validated"),
    "validity_split": sql("""SELECT run_id, source, count(*) AS rows_count, 0::BIGINT AS token_slots, is_valid AS valid
FROM validated GROUP BY run_id, source, is_valid"""),
    "reason_violations": sql(f"SELECT reason_id, entity, 'unknown entity' AS violations FROM reasons WHERE entity = {q(D.ENTITIES[0])}"),
    "repeated_identities": sql("""SELECT source, source_id, count(*) AS rows_count, 'validated' AS stage FROM validated
WHERE review_id IS NOT NULL GROUP BY source, source_id HAVING count(*) > 1
UNION ALL SELECT source, source_id, count(*), 'deduplicated' FROM dedup
WHERE review_id IS NOT NULL GROUP BY source, source_id HAVING count(*) > 1"""),
    "latest_reviews": sql(f"SELECT row_id, review_id, run_id, is_valid, {ts('ingested_at')} AS ingested_at FROM dedup"),
    "dq_metrics_by_run": _dq(),
    "dq_invalid_reasons_by_run": sql("""SELECT run_id, source_file, reason AS invalid_reason, count(*) AS rows_count
FROM (SELECT run_id, source_file, unnest(invalid_reason) AS reason FROM validated) GROUP BY ALL ORDER BY run_id, rows_count DESC, source_file, invalid_reason"""),
    "normalised_text": sql(f"SELECT row_id, lower(translate({chain('review_text', DEFAULT_DELIMITERS)}, {q(X._FULLWIDTH)}, {q(X._HALFWIDTH)})) AS normalised FROM raw"),
    "sentence_rows": sql(f"""SELECT row_id, sentence, sentence_text FROM (
  SELECT row_id, unnest(parts) AS sentence_text, generate_subscripts(parts, 1) AS sentence FROM (
    SELECT row_id, string_split(lower(translate({chain('review_text', SPACED_DELIMITERS)}, {q(X._FULLWIDTH)}, {q(X._HALFWIDTH)})), '|') AS parts FROM valid))
WHERE sentence_text <> ''"""),
    "word_tokens": sql("""SELECT row_id, sentence, idx AS "index", idx_in_sentence AS index_in_sentence, surface, pos, sub_pos, inflection, lemma FROM tokens"""),
    "polarity_tokens": sql("""SELECT t.row_id, t.idx AS "index", t.lemma, s.polarity AS sentiment
FROM tokens t LEFT JOIN sentiments s ON s.term = t.lemma AND s.polarity = 'negative'"""),
    "synonym_tokens": sql("""SELECT t.row_id, t.idx AS "index", t.lemma, t.pos, s.synonym FROM tokens t LEFT JOIN synonyms s ON s.lemma = t.lemma AND s.pos = t.pos"""),
    "category_tokens": sql("""SELECT t.row_id, t.idx AS "index", t.lemma, e.entity, i.issue_category
FROM tokens t LEFT JOIN entities e ON e.term = t.lemma LEFT JOIN issues i ON i.term = t.lemma"""),
    "compound_tokens": sql("""SELECT row_id, sentence, place, w.surface, w.pos, w.sub_pos, w.inflection, w.lemma, w.s::INT AS start_offset, w.e::INT AS end_offset
FROM (SELECT row_id, w, place, 1 + sum((w.surface = '|')::INT) OVER (PARTITION BY row_id ORDER BY place)::INT AS sentence
      FROM (SELECT row_id, unnest(words) AS w, generate_subscripts(words, 1) - 1 AS place FROM folded)) WHERE w.surface <> '|'""", _compound_extra()),
    "subject_islands": sql("""SELECT row_id, sentence, idx AS "index", nth, min(nth_seen) AS island FROM (
  SELECT *, max(seen) FILTER (verbal AND nouns > 0 AND coalesce(flag, 0) = 0) OVER (PARTITION BY row_id, idx) AS stop FROM (
    SELECT a.row_id, a.sentence, a.idx, a.nth, r.idx AS seen, r.nth AS nth_seen, r.en, r.verbal,
           sum(r.en::INT) OVER w AS nouns,
           last_value(CASE WHEN r.en OR r.blocker THEN 0 WHEN r.link THEN 1 END IGNORE NULLS) OVER w AS flag
    FROM nouns a JOIN numbered r ON r.row_id = a.row_id AND r.sentence = a.sentence AND r.idx <= a.idx
    WINDOW w AS (PARTITION BY a.row_id, a.idx ORDER BY r.idx DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)))
WHERE en AND (stop IS NULL OR seen > stop) GROUP BY row_id, sentence, idx, nth""", {
        "numbered": "SELECT *, sum(en::INT) OVER (PARTITION BY row_id ORDER BY idx)::INT AS nth FROM roles",
        "nouns": "SELECT * FROM numbered WHERE en"}),
    "noun_term_pairs": pairs("noun_then_predicate", "noun_as_predicate", "noun_alone"),
    "modifier_term_pairs": pairs("modifier"),
    "own_sentence_pairs": pairs("subject_before", "subject_after"),
    "merged_sentence_pairs": pairs("earlier_sentence", "later_sentence", "no_subject"),
    "term_pairs_default_split": pairs(extra=_DEFAULT_SPLIT),
    "split_reasons": sql("""SELECT c.row_id, x.polarity AS sentiment_type, count(*) AS reason_rows, count(k.idx) AS with_predicate,
  count(s.subject_idx) AS with_subject
FROM cases c JOIN sentiments x ON x.term = c.term LEFT JOIN subject_lists s USING (row_id, p) LEFT JOIN predicates k USING (row_id, p) GROUP BY ALL"""),
    "distinct_reasons": sql(f"""SELECT row_id, sentiment_type, {joined('subject_idx')} AS subject_indices, coalesce(predicate_idx, -1) AS predicate_index,
  coalesce(list_min([abs(i - predicate_idx) FOR i IN subject_idx]), -1) AS distance FROM pairs"""),
    "reason_records": sql(f"SELECT {REASON_OUT} FROM reasons"),
    "reasons_enriched": sql(f"""SELECT run_id, source_file, source, {ts('posted_at_iso')} AS posted_at_iso, {day('posted_date')} AS posted_date,
  {ts('ingested_at')} AS ingested_at, review_text, {REASON_OUT.replace(", run_id", "")} FROM joined"""),
    "best_reason_per_review": sql(f"""SELECT run_id, source_file, source, {day('posted_date')} AS posted_date, review_text,
  sentiment_type, entity, issue_category, round(confidence, 6) AS confidence, {joined('subject')} AS subject_array, {joined('subject')} AS subject,
  predicate, review_id, reason_id FROM top1"""),
    "kpi_reason_categories_daily": kpi("entity, issue_category", "count(*) AS reason_count, count(DISTINCT review_id) AS review_count"),
    "kpi_entity_counts": kpi("entity", "count(*) AS review_count"),
    "kpi_issue_category_counts": kpi("issue_category", "count(*) AS review_count"),
    "kpi_top_subject_predicate": sql(f"""SELECT {DAY_OUT}, subject_token, predicate, count(*) AS pair_count, count(DISTINCT review_id) AS review_count, {AVG}
FROM (SELECT * EXCLUDE (subject), unnest(subject) AS subject_token FROM top1) GROUP BY {DAY_KEYS}, subject_token, predicate"""),
    "kpi_entity_issue_coverage": sql(f"""SELECT count(*) AS total_records, count(entity) AS entity_filled_count, {rate('count(entity)', 'count(*)')} AS entity_coverage_rate,
  count(issue_category) AS issue_category_filled_count, {rate('count(issue_category)', 'count(*)')} AS issue_category_coverage_rate FROM top1"""),
    "kpi_extraction_coverage_by_run": _coverage(),
    "top_entities": top("entity", "top1 WHERE entity IS NOT NULL"),
    "top_issue_categories": top("issue_category", "top1 WHERE issue_category IS NOT NULL"),
    "top_subject_predicates": top("subject_token, predicate", "(SELECT unnest(subject) AS subject_token, predicate FROM top1) WHERE predicate IS NOT NULL"),
    "top_issues_per_entity": sql("""SELECT entity, issue_category, reason_count, rank::INT AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY entity ORDER BY reason_count DESC, issue_category) AS rank FROM (
    SELECT entity, issue_category, count(*) AS reason_count FROM top1 WHERE entity IS NOT NULL AND issue_category IS NOT NULL GROUP BY ALL))
WHERE rank <= 3"""),
    "entity_issue_heatmap": _heatmap(),
    "daily_trend": sql(f"""SELECT {day('posted_date')} AS posted_date, sentiment_type, count(*) AS reason_count, count(DISTINCT review_id) AS review_count
FROM top1 GROUP BY top1.posted_date, sentiment_type"""),
    "run_drilldown": sql(f"""SELECT v.review_id, v.run_id, v.source_file, v.row_number, v.row_id, v.source, {ts('v.posted_at_iso')} AS posted_at_iso, v.is_valid,
  {joined('v.invalid_reason', '; ')} AS invalid_reason, r.sentiment_type, {joined('r.subject')} AS subject, r.predicate, r.entity, r.issue_category,
  round(r.confidence, 6) AS confidence, r.reason_id
FROM validated v LEFT JOIN reasons r ON v.is_valid AND r.review_id = v.review_id AND r.run_id = 'run_b' WHERE v.run_id = 'run_b'"""),
    "extraction_quality": sql(f"""SELECT count(*) AS labelled_reviews, count(reason_id) AS extracted_reviews,
  {rate('count(reason_id)', 'count(*)')} AS extraction_coverage,
  {rate('count(*) FILTER (reason_id IS NOT NULL AND is_correct)', 'count(reason_id)')} AS extraction_precision,
  {rate('count(*) FILTER (entity = gold_entity)', 'count(reason_id)')} AS entity_accuracy,
  {rate('count(*) FILTER (issue_category = gold_issue)', 'count(reason_id)')} AS issue_accuracy FROM judged""", _GOLD),
    "entity_label_quality": _label_quality("entity", "gold_entity"),
    "issue_label_quality": _label_quality("issue_category", "gold_issue"),
    "compatibility_forms": sql(f"SELECT row_id, nfc_normalize(translate(review_text, {q(X._FULLWIDTH)}, {q(X._HALFWIDTH)})) AS folded FROM raw"),
    "orthographic_forms": sql(f"SELECT row_id, {orthography('review_text')} AS unified FROM raw"),
}
