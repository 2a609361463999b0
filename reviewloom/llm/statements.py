"""DuckDB statements for the queries that SQL can express, by the plainest definition."""

from __future__ import annotations

STATEMENTS = {
    "op1_exact_dedup": r"""
        with rows as (
            select doc_id, coalesce(text, '') as original,
                   regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') as body
            from documents
        ), classes as (
            select body, count(*) as group_size,
                   first(doc_id order by length(original) desc, doc_id nulls last) as keep_id
            from rows group by body
        )
        select doc_id, keep_id, group_size, doc_id is not distinct from keep_id as kept,
               sha256(body) as text_sha256
        from rows join classes using (body)
    """,
    "op2_decontaminate": r"""
        with cut as (
            select doc_id, text, list_filter(
                regexp_split_to_array(
                    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as w
            from documents
        ), items as (
            select cast(item_id as varchar) as item_id, list_filter(
                regexp_split_to_array(
                    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as w
            from benchmark
        ), windows as (
            select distinct item_id, list_slice(w, p0, p0 + 9) as words
            from (select item_id, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) as p0
                  from items where len(w) > 0)
        ), lengths as (select distinct len(words) as n from windows
        ), hits as (
            select d.doc_id, d.p0, d.n, x.item_id
            from (select doc_id, n, p0, list_slice(w, p0, p0 + n - 1) as words
                  from (select doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) as p0
                        from cut, lengths)) d
            join windows x on x.words = d.words
        ), covered as (
            select doc_id, count(distinct p) as n_hit
            from (select doc_id, unnest(generate_series(p0, p0 + n - 1)) as p
                  from (select distinct doc_id, p0, n from hits))
            group by doc_id
        ), named as (
            select doc_id, count(*) as n_items, string_agg(item_id, ',' order by item_id) as ids
            from (select distinct doc_id, item_id from hits) group by doc_id
        )
        select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit,
               coalesce(n_items, 0) as n_items, sha256(coalesce(ids, '')) as items_sha256,
               coalesce(n_hit, 0) > 0 as contaminated
        from cut left join covered using (doc_id) left join named using (doc_id)
    """,
    "op10_line_dedup": r"""
        with lines as (
            select doc_id, line, i,
                   translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
            from (select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
                         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as i
                  from documents)
        ), repeated as (
            select key, min(doc_id) as first_doc from lines where length(key) >= 10
            group by key having count(distinct doc_id) > 1
        ), marked as (
            select lines.*, coalesce(doc_id <> first_doc, false) as gone
            from lines left join repeated using (key)
        )
        select doc_id, count(*) as n_lines, count(*) filter (gone) as n_dropped,
               sha256(coalesce(string_agg(line, chr(10) order by i) filter (not gone), '')) as kept_sha256
        from marked group by doc_id
    """,
    "op8_warc": r"""
        with hashed as (
            select page_id, strlen(html) as payload_bytes, sha1(html) as x,
                   min(page_id) over (partition by html) as first_page
            from (select page_id, coalesce(html, '') as html from pages)
        )
        select page_id, payload_bytes,
               array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                   ((cast('0x' || substr(x, (5 * i) // 4 + 1, 2) as integer) >> (3 - (5 * i) % 4)) & 31) + 1, 1)
                   for i in range(32)], '') as payload_digest,
               case when page_id = first_page then 'response' else 'revisit' end as record_type,
               case when page_id <> first_page then first_page end as refers_to
        from hashed
    """,
    "op9_jaccard_join": r"""
        with recursive cut as (
            select doc_id, list_filter(
                regexp_split_to_array(
                    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                    '[\x20\x09-\x0D]+'), lambda x: x <> '') as w
            from documents
        ), shingles as (
            select distinct doc_id, array_to_string(list_slice(w, p0, p0 + 2), ' ') as s
            from (select doc_id, w, unnest(generate_series(1, greatest(len(w) - 2, 1))) as p0
                  from cut where len(w) > 0)
        ), sizes as (select doc_id, count(*) as n from shingles group by doc_id
        ), shared as (
            select a.doc_id as a, b.doc_id as b, count(*) as both_n
            from shingles a join shingles b on a.s = b.s and a.doc_id < b.doc_id group by 1, 2
        ), linked as (
            select a, b from shared join sizes x on x.doc_id = a join sizes y on y.doc_id = b
            where 100 * both_n >= 90 * (x.n + y.n - both_n)
        ), both_ways as (select a, b from linked union all select b, a from linked
        ), reach as (
            select doc_id as a, doc_id as b from documents
            union
            select reach.a, both_ways.b from reach join both_ways on reach.b = both_ways.a
        )
        select doc_id, coalesce(max(n), 0) as n_shingles, min(b) as component_id
        from documents left join sizes using (doc_id) join reach on reach.a = doc_id
        group by doc_id
    """,
    "op12_lexical_search": r"""
        with cut as (
            select row_number() over () as r, doc_id, list_filter(
                regexp_split_to_array(
                    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                    '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: x <> '') as w
            from documents
        ), items as (
            select distinct item_id, unnest(list_filter(
                regexp_split_to_array(
                    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                    '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: x <> '')) as term
            from benchmark
        ), counted as (
            select r, term, count(*) as tf from (select r, unnest(w) as term from cut)
            where term in (select term from items) group by r, term
        ), whole as (
            select count(*) filter (len(w) > 0) as n_docs, sum(len(w)) as n_terms from cut
        ), weights as (
            select term, cast(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) as bigint) as weight
            from counted, whole group by term, n_docs
        ), lengths as (
            select r, doc_id, cast(10 + (90 * len(w) * n_docs) // n_terms as bigint) as m
            from cut, whole where len(w) > 0
        ), scores as (
            select item_id, doc_id, r,
                   cast(sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * m))) as bigint) as score
            from counted join weights using (term) join lengths using (r) join items using (term)
            group by item_id, doc_id, r
        ), ranked as (
            select item_id, doc_id, score,
                   cast(row_number() over (partition by item_id order by score desc, doc_id) as integer) as rank
            from scores where score > 0
        )
        select item_id, rank, doc_id, score from ranked where rank <= 10
    """,
    "op13_source_divergence": r"""
        with texts as (
            select row_number() over () as r, coalesce(lang, '') as lang, coalesce(source, '') as source,
                   list_filter(regexp_split_to_array(
                       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[\x00-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: x <> '') as w
            from documents
        ), words as (
            select lang, source, term, r, count(*) as n
            from (select lang, source, r, unnest(w) as term from texts) group by all
        ), kept as (
            select lang, term, sum(n) as n from words group by lang, term having count(*) >= 30
        ), langs as (select lang, count(*) as v, sum(n) as total from kept group by lang
        ), groups as (select distinct lang, source from texts
        ), used as (
            select words.lang, words.source, words.term, sum(words.n) as n
            from words join kept on kept.lang = words.lang and kept.term = words.term group by all
        ), totals as (
            select g.lang, g.source, coalesce(sum(u.n), 0) as total
            from groups g left join used u on u.lang = g.lang and u.source = g.source group by all
        ), shares as (
            select t.lang, t.source, k.term, coalesce(u.n, 0) as n,
                   1 + (1000000000 * cast(coalesce(u.n, 0) + 5 as hugeint)) // (t.total + 5 * l.v) as p,
                   1 + (1000000000 * cast(k.n + 5 as hugeint)) // (l.total + 5 * l.v) as q
            from totals t join kept k on k.lang = t.lang join langs l on l.lang = t.lang
            left join used u on u.lang = t.lang and u.source = t.source and u.term = k.term
        ), apart as (
            select a.lang, a.source, b.source as item, sum(abs(a.p - b.p)) as value
            from shares a join shares b on a.lang = b.lang and a.term = b.term and a.source <> b.source
            group by all
        ), parts as (
            select g.lang, g.source, 'pair' as part, h.source as item,
                   cast(coalesce(value, 0) as bigint) as value
            from groups g join groups h on g.lang = h.lang and g.source <> h.source
            left join apart x on x.lang = g.lang and x.source = g.source and x.item = h.source
            union all
            select lang, source, 'term', term, cast(p - q as bigint) from shares where n > 0 and p > q
        ), ranked as (
            select *, cast(row_number() over (
                partition by lang, source, part order by value desc, item) as integer) as rank
            from parts
        )
        select * from ranked where part = 'pair' or rank <= 50
    """,
}
