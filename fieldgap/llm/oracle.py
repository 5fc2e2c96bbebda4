"""DuckDB statements for the queries that SQL can express. Constants are written out here again."""

from __future__ import annotations

WORDS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

LINE_DEDUP = r"""
with lines as (
  select doc_id, u.i as i, u.line as line,
         cast(('0x' || substr(md5(u.line), 1, 8)) as bigint) as h,
         strlen(u.line) >= 99 and len(regexp_extract_all(u.line, '[^ \t\r\x0B\f]+')) >= 50 as long_line, trim(u.line, ' ' || chr(9) || chr(13) || chr(11) || chr(12)) <> '' as has_words
  from (select doc_id, unnest(list_transform(string_split(text, chr(10)), lambda x, i: {'i': i, 'line': x})) as u
        from documents where text is not null)
), cut as (
  select *, ((h + 31 * coalesce(lag(h) over d, 0)) % 3 = 0 or long_line or coalesce(lead(long_line) over d, true)) as last
  from lines window d as (partition by doc_id order by i)
), numbered as (
  select *, coalesce(sum(last::int) over (partition by doc_id order by i rows between unbounded preceding and 1 preceding), 0) as k
  from cut
), chunks as (
  select doc_id, k, string_agg(line, chr(10) order by i) as body, count(*) as n,
         count(*) filter (has_words) > 1 or bool_or(long_line) as full_chunk
  from numbered group by doc_id, k
), groups as (
  select body, count(*) as copies, min(doc_id) as keeper from chunks where full_chunk group by body
), judged as (
  select c.*, full_chunk and copies > 1
         and not (c.doc_id = keeper and row_number() over (partition by c.doc_id, c.body, c.full_chunk order by k) = 1) as gone
  from chunks c left join groups using (body)
)
select d.doc_id, coalesce(j.body, case when d.text is null then null else '' end) as text,
       coalesce(j.n_lines, 0)::bigint as n_lines, coalesce(j.n_removed, 0)::bigint as n_removed
from documents d left join (
  select doc_id, string_agg(body, chr(10) order by k) filter (not gone) as body, sum(n) as n_lines,
         coalesce(sum(n) filter (gone), 0) as n_removed
  from judged group by doc_id
) j using (doc_id)
"""

DECONTAMINATION = f"""
with words as (select doc_id, {WORDS} as w from documents where text is not null),
items as (select item_id, {WORDS} as w from benchmark where text is not null),
windows as (
  select distinct item_id, least(13, len(w)) as size, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') as body
  from (select *, unnest(range(1, len(w) - least(13, len(w)) + 2)) as i from items where len(w) > 0)
), places as (
  select doc_id, i, size, array_to_string(w[i:i + size - 1], ' ') as body
  from (select *, unnest(range(1, len(w) - size + 2)) as i
        from words, (select distinct size from windows) where len(w) >= size)
), found as (select doc_id, i, p.size, item_id from places p join windows using (size, body)),
hit as (select doc_id, count(distinct p) as n from (select doc_id, unnest(range(i, i + size)) as p from found) group by doc_id),
owners as (
  select doc_id, count(*) as n, string_agg(item, ',' order by item) as items
  from (select distinct doc_id, item_id::varchar as item from found) group by doc_id
)
select d.doc_id, coalesce(len(words.w), 0)::bigint as n_words, coalesce(hit.n, 0)::bigint as n_hit,
       coalesce(owners.n, 0)::bigint as n_items, sha256(coalesce(owners.items, '')) as items_sha256,
       coalesce(hit.n, 0) > 0 and 20 * coalesce(hit.n, 0) >= coalesce(len(words.w), 0) as contaminated
from documents d left join words using (doc_id) left join hit using (doc_id) left join owners using (doc_id)
"""

HTML = r"""
with body as (
  select page_id, url, regexp_extract(html, '(?s)<article>(.*?)</article>', 1) as a from pages
), blocks as (
  select page_id, unnest(list_transform(
    regexp_split_to_array(a, '</?(?:p|h1|div|ul|li)>'),
    lambda x, i: {'i': i, 'b': regexp_replace(replace(x, '<br>', ' '), '<[^>]*>', '', 'g')}
  )) as u from body
), clean as (
  select page_id, u.i as i, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
    u.b, '&lt;?', '<', 'g'), '&gt;?', '>', 'g'), '&quot;?', '"', 'g'), '&amp;?', '&', 'g'), '\s+', ' ', 'g')) as b
  from blocks
), texts as (select page_id, string_agg(b, chr(10) order by i) as text from clean where b <> '' group by page_id)
select page_id, url, coalesce(text, '') as text, length(coalesce(text, ''))::bigint as n_chars
from pages left join texts using (page_id)
"""

TOP_K = """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(64 * x::double)::bigint) as e
  from embeddings where embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0 and vec_id is not null
), scores as (
  select q.vec_id as query_id, c.vec_id as vec_id,
         list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2]))::bigint as score
  from v q join v c on q.vec_id % 20 = 0 and q.vec_id <> c.vec_id
)
select query_id, rank::integer as rank, vec_id, score
from (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from scores)
where rank <= 20
"""

URLS = """
with cut as (
  select page_id, case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest from pages
), parsed as (
  select page_id,
         translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
         regexp_extract(rest, '^[^/?#]*(/[^?#]*)', 1) as path
  from cut
), rules(verdict, host, path) as (
  values ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
         ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
), fits as (
  select p.page_id, r.host || r.path as rule, r.verdict,
         row_number() over (partition by p.page_id order by length(r.host || r.path) desc) as n
  from parsed p join rules r on (p.host = r.host or ends_with(p.host, '.' || r.host)) and starts_with(p.path, r.path)
)
select p.page_id, host, path, rule, coalesce(verdict, 'allow') as verdict
from parsed p left join (select * from fits where n = 1) f using (page_id)
"""

WARC = """
with p as (
  select page_id, strlen(coalesce(html, ''))::bigint as payload_bytes, sha1(coalesce(html, '')) as h from pages
), d as (
  select page_id, payload_bytes, max(page_id) over (partition by h) as holder,
         array_to_string(list_transform(range(0, 32), lambda k:
           substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                  ((((('0x' || substr(h, (5 * (k // 4) + 1)::int, 5))::integer) >> (15 - 5 * (k % 4))::int) & 31) + 1)::int, 1)), '') as payload_digest
  from p
)
select page_id, payload_bytes, payload_digest, case when holder = page_id then 'response' else 'revisit' end as record_type,
       case when holder <> page_id then holder end as refers_to
from d
"""

STATEMENTS: dict[str, str] = {
    "op1_html_extraction": HTML,
    "op3_line_dedup": LINE_DEDUP,
    "op4_exact_top_k": TOP_K,
    "op5_benchmark_decontamination": DECONTAMINATION,
    "op6_url_filter": URLS,
    "op9_warc": WARC,
}
