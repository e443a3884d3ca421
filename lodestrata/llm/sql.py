"""DuckDB SQL for the contract queries that SQL can express."""

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WHITE = r"chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

OP5 = f"""
with lines as (
    select doc_id, generate_subscripts(parts, 1) as pos, unnest(parts) as line
    from (select doc_id, string_split(coalesce(text, ''), chr(10)) as parts from documents)
), keyed as (
    select *, {_LOWER.format(f"trim(line, {_WHITE})")} as k from lines
), common as (
    select k, max(doc_id) as last_id from keyed where length(k) >= 40 group by k having count(distinct doc_id) >= 5
), judged as (
    select doc_id, pos, line, common.k is not null and doc_id <> last_id as gone from keyed left join common using (k)
)
select doc_id, count(*) as n_lines, count(*) filter (gone) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (not gone), '')) as kept_sha256
from judged group by doc_id
"""

OP6 = r"""
with words as (
    select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents
), windows as (
    select doc_id, i, array_to_string(w[i:i + 19], ' ') as win
    from (select doc_id, w, unnest(range(1, len(w) - 18)) as i from words where len(w) >= 20)
), later as (
    select doc_id, i from (select doc_id, i, row_number() over (partition by win order by doc_id, i) as n from windows) where n > 1
), gone as (
    select distinct doc_id, pos from (select doc_id, unnest(range(i, i + 20)) as pos from later)
), each as (
    select doc_id, unnest(w) as word, generate_subscripts(w, 1) as pos from words
), kept as (
    select doc_id, sum((g.pos is not null)::int)::bigint as n_removed, string_agg(word, ' ' order by e.pos) filter (g.pos is null) as kept
    from each e left join gone g using (doc_id, pos) group by doc_id
)
select doc_id, len(w)::bigint as n_words, coalesce(n_removed, 0)::bigint as n_removed, sha256(coalesce(kept, '')) as kept_sha256
from words left join kept using (doc_id)
"""

OP10 = f"""
with rules(host, path, verdict) as (
    values ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), rest as (
    select page_id, case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) else '' end as r from pages
), split as (
    select page_id, {_LOWER.format("regexp_extract(coalesce(r, ''), '^[^/?#]*', 0)")} as host,
           regexp_extract(coalesce(r, ''), '^[^/?#]*([^?#]*)', 1) as path from rest
), fits as (
    select s.page_id, r.host || r.path as rule, r.verdict, row_number() over (partition by s.page_id order by length(r.host || r.path) desc) as n
    from split s join rules r on (s.host = r.host or ends_with(s.host, '.' || r.host)) and starts_with(s.path, r.path)
)
select page_id, host, path, rule, coalesce(verdict, 'allow') as verdict
from split left join (select page_id, rule, verdict from fits where n = 1) using (page_id)
"""

ORACLE_SQL = {"op5_line_dedup": OP5, "op6_substring_dedup": OP6, "op10_url_filters": OP10}
