"""SQL of the queries that SQL can express, with values of its own."""

SECRETS = r"""
with texts as (
  select row_number() over () as rid, doc_id, coalesce(source, '') as owner,
         concat_ws('/', source, lang) as repository, coalesce(text, '') as t
  from documents
), lists as (
  select rid, 0 as kind, 8 as enough,
    string_split_regex(t, '([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)') as ps,
    regexp_extract_all(t, '([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)') as ms,
    regexp_extract_all(t, '([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2) as vs
  from texts
  union all
  select rid, 1, 16, string_split_regex(t, 'AKIA[A-Z0-9]+'), regexp_extract_all(t, 'AKIA[A-Z0-9]+'),
    regexp_extract_all(t, 'AKIA[A-Z0-9]+') from texts
  union all
  select rid, 2, 32, string_split_regex(t, '[0-9a-f]+'), regexp_extract_all(t, '[0-9a-f]+'),
    regexp_extract_all(t, '[0-9a-f]+') from texts
), matches as (
  select rid, kind, enough, unnest(range(1, len(ms) + 1)) as nth, unnest(ms) as m,
         unnest(vs) as v, unnest(ps[1:len(ms)]) as p
  from lists where len(ms) > 0
), spans as (
  select rid, kind, v, length(v) as width, length(v) >= enough as holds,
         sum(length(p) + length(m)) over (partition by rid, kind order by nth) as stop, length(m) as size
  from matches
), base as (
  select rid, kind, v, width, (stop - size)::bigint as start, stop::bigint as stop
  from spans where holds
), spread as (
  select v, count(distinct owner) as owners, count(distinct repository) as repositories
  from base join texts using (rid) group by v
), judged as (
  select rid, stop - width as start, stop, owners, repositories,
         case when owners >= 3 then 4
              when len(list_distinct(string_split(v, ''))) >= 6
                   and (regexp_matches(v, '[0-9]') or kind = 2
                        or (kind = 1 and regexp_full_match(v, 'AKIA[A-Z2-7]{16}'))
                        or (kind = 0 and (length(v) >= 12
                                          or regexp_matches(v, '[a-z]') and regexp_matches(v, '[A-Z]'))))
              then 3
              else 5 end as kind
  from base join spread using (v)
), every as (
  select rid, start, kind, stop from base union select rid, start, kind, stop from judged
), named as (
  select rid, start, kind, list_value('assign', 'access', 'hex', 'live', 'example', 'placeholder')[kind + 1]
         || ':' || start || ':' || stop as name, stop
  from every
), lines as (
  select rid, string_agg(name, ',' order by start, kind, stop) as spans,
         coalesce(string_agg(name, ',' order by start, kind, stop) filter (kind < 3), '') as base,
         count(*) filter (kind = 0) as n_assign, count(*) filter (kind = 1) as n_access,
         count(*) filter (kind = 2) as n_hex
  from named group by rid
), widest as (
  select rid, max(owners) as max_owners, max(repositories) as max_repositories from judged group by rid
)
select doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access,
       coalesce(n_hex, 0) as n_hex, sha256(coalesce(base, '')) as base_sha256,
       coalesce(spans, '') as spans, coalesce(max_owners, 0) as max_owners,
       coalesce(max_repositories, 0) as max_repositories
from texts left join lines using (rid) left join widest using (rid)
"""

FIXITY = r"""
with copies as (
  select 'a' as side, page_id, url, coalesce(html, '') as body from pages
  union all
  select 'b', unnest(case when page_id % 97 = 20 then []::bigint[]
                          when page_id % 97 = 30 then [page_id, page_id]
                          when page_id % 97 = 60 then [page_id, -1 - page_id] else [page_id] end), url, coalesce(
    case when page_id % 97 = 5 then '?' || substring(html, 2)
         when page_id % 97 = 50 then left(html, greatest(length(html) - 10, 0)) else html end, '')
  from pages
), records as (
  select side, page_id, floor(page_id / 1024)::bigint as file,
    'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10)
    || 'WARC-Record-ID: <urn:page:' || coalesce(page_id::varchar, '') || '>' || chr(13) || chr(10)
    || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10)
    || 'Content-Type: text/html' || chr(13) || chr(10) || 'Content-Length: ' || strlen(body)
    || chr(13) || chr(10) || chr(13) || chr(10) || body || chr(13) || chr(10) || chr(13) || chr(10)
    as record
  from copies
), hashed as (
  select side, file, page_id, sha256(record) as digest, strlen(record) as len, count(*) as copies
  from records group by all
), placed as (
  select *, (sum(len * copies) over (partition by side, file order by page_id, digest, len
                                     rows unbounded preceding))::bigint as stop
  from hashed
), leaves as (
  select coalesce(a.file, b.file) as file, coalesce(a.page_id, b.page_id) as page_id,
         a.stop - a.len * a.copies as begin_a, a.stop as end_a, a.digest as digest_a, a.copies as copies_a,
         b.stop - b.len * b.copies as begin_b, b.stop as end_b, b.digest as digest_b, b.copies as copies_b
  from (from placed where side = 'a') a full join (from placed where side = 'b') b
    on a.page_id is not distinct from b.page_id and a.digest = b.digest
  where a.copies is distinct from b.copies
), per_id as (
  select file, page_id, max(begin_a) as begin_a, max(end_a) as end_a, max(digest_a) as digest_a,
         max(copies_a) as copies_a, max(begin_b) as begin_b, max(end_b) as end_b,
         max(digest_b) as digest_b, max(copies_b) as copies_b,
         count(*) = 2 and count(digest_a) = 1 and count(digest_b) = 1 and page_id is not null as paired
  from leaves group by file, page_id
)
select * exclude (paired), 'differs' as status from per_id where paired
union all
select l.*, case when l.digest_b is null then 'missing' when l.digest_a is null then 'extra'
                 else 'repeated' end
from leaves l join per_id p on l.page_id is not distinct from p.page_id where not p.paired
"""
