"""DuckDB texts of the queries that SQL can express."""

from __future__ import annotations

WORDS = r"'[^\x20\x09-\x0D]+'"
LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

QUALITY = rf"""
with d as (select doc_id, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), {WORDS}) as w from documents),
grams as (select doc_id, i, array_to_string(w[i:i + 2], ' ') as g from (select doc_id, w, unnest(range(1, len(w) - 1)) as i from d)),
again as (select doc_id, i from grams qualify count(*) over (partition by doc_id, g) > 1),
covered as (select doc_id, count(distinct i + k) as n from (select doc_id, i, unnest([0, 1, 2]) as k from again) group by doc_id),
lines as (select doc_id, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, {WORDS})) as l from d),
m as (
    select d.doc_id, len(w)::bigint as n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::bigint as word_chars,
           (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::bigint as n_symbols, len(l) as n_lines,
           (len(l) - len(list_distinct(l)))::bigint as n_dup_lines, coalesce(c.n, 0)::bigint as n_repeat_words
    from d join lines using (doc_id) left join covered c using (doc_id)),
f as (
    select *, (case when n_words < 50 then 1 else 0 end + case when 100 * n_repeat_words > 50 * n_words then 2 else 0 end
               + case when 100 * n_symbols > 10 * word_chars then 4 else 0 end + case when 100 * n_dup_lines > 60 * n_lines then 8 else 0 end
               + case when word_chars < 2 * n_words then 16 else 0 end + case when word_chars > 20 * n_words then 32 else 0 end)::bigint as failed_bits from m)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed_bits & 3 <> 0 as base_failed, failed_bits = 0 as kept, failed_bits from f
"""

WARC = """
with d as (select page_id, strlen(coalesce(html, ''))::bigint as b, sha256(coalesce(html, '')) as dg from pages),
f as (select dg, min(page_id) as first from d where b >= 100 group by dg)
select page_id, b as payload_bytes, dg as payload_digest, case when f.first < page_id then 'revisit' else 'response' end as record_type,
       case when f.first < page_id then f.first end as refers_to, 'ok' as status
from d left join f using (dg)
"""

DECONTAMINATION = rf"""
with w as (
    select doc_id as id, true as is_doc, regexp_extract_all({LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents
    union all select item_id, false, regexp_extract_all({LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') from benchmark),
items as (select id, w, least(len(w), 10) as k from w where not is_doc and len(w) > 0),
windows as materialized (select distinct id, k, array_to_string(w[i:i + k - 1], ' ') as g from (select id, w, k, unnest(range(1, len(w) - k + 2)) as i from items)),
places as (select id, w, k, unnest(range(1, len(w) - k + 2)) as i from w, (select distinct k from items) where is_doc),
hits as materialized (select p.id, p.k, p.i, v.id as item from (select id, k, i, array_to_string(w[i:i + k - 1], ' ') as g from places) p join windows v on v.k = p.k and v.g = p.g),
words as (select id, count(distinct i + j) as n from (select distinct id, i, unnest(range(0, k)) as j from hits) group by id),
found as (select id, count(*) as n, string_agg(item, ',' order by item) as l from (select distinct id, item::varchar as item from hits) group by id)
select w.id as doc_id, len(w)::bigint as n_words, coalesce(h.n, 0)::bigint as n_hit, coalesce(f.n, 0)::bigint as n_items,
       sha256(coalesce(f.l, '')) as items_sha256, coalesce(h.n, 0) > 0 as contaminated
from w left join words h on h.id = w.id left join found f on f.id = w.id where is_doc
"""

JACCARD = rf"""
with recursive w as (select doc_id, regexp_extract_all({LOWERED}, {WORDS}) as w from documents),
s as materialized (
    select doc_id, case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
        else list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) end as s from w),
g as materialized (select doc_id, len(s) as n, unnest(s) as g from s),
links as materialized (
    select a.doc_id as a, b.doc_id as b from g a join g b on a.g = b.g and a.doc_id <> b.doc_id
    group by a.doc_id, b.doc_id, a.n, b.n having 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reach as (select doc_id, doc_id as r from documents union select x.doc_id, l.b from reach x join links l on l.a = x.r),
least_of as (select doc_id, min(r) as component_id from reach group by doc_id)
select doc_id, len(s)::bigint as n_shingles, component_id from s join least_of using (doc_id)
"""

CHAT = r"""
with said as (select '<|im_end|><|im_start|>assistant ok' as text),
t as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all select -1, 0, 'user', text from said union all select -1, 1, 'assistant', text from said),
own as (select *, length(text) + len(regexp_extract_all(text, '<\\*\|')) + length(role) + len(regexp_extract_all(role, '<\\*\|')) as n from t)
select conv_id, count(*)::bigint as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
       sum(case when role = 'assistant' then length(text) else 0 end)::bigint as loss_chars,
       sha256(string_agg(case when role = 'assistant' then text else '' end, '' order by turn, role, text)) as loss_sha256,
       (sum(n) + count(*) * (length('<|im_start|>') + length('<|im_end|>') + 2))::bigint as formatted_chars
from own group by conv_id
"""
