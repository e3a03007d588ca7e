"""The queries as DuckDB SQL, where SQL can express them.

Not here: token files (a tokenizer), language ID, toxicity and the language model (trained
models), WARC records (base 32, name-based ids), periodic runs (all periods at all places). Tests check those against plain versions.
"""

from __future__ import annotations

from tapewire.llm.inputs import cte
from tapewire.llm.mixing import BLOCK_TOKENS, SEED

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(pattern: str) -> str:
    return f"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{pattern}')"


# Links (a, b) in both directions, as the smallest id that each one reaches.
_REACH = """
reach(a, b) as (select a, b from links union select r.a, l.b from reach r join links l on r.b = l.a),
lowest as (select a, min(b) as low from reach group by a)"""

ORACLE: dict[str, str] = {}

ORACLE["op3_embedding_near_dedup"] = f"""
with recursive v as (
  select vec_id, label, list_transform(embedding, lambda x: cast(x as double)) as e
  from embeddings where label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0),
links as (
  select p.vec_id as a, q.vec_id as b from v p join v q
  on p.label = q.label and p.vec_id <> q.vec_id and len(p.e) = len(q.e)
    and list_cosine_similarity(p.e, q.e) >= 0.93),
{_REACH},
degrees as (select a, count(*) as n from links group by a)
select m.vec_id, cast(coalesce(d.n, 0) as bigint) as n_links,
  least(m.vec_id, coalesce(low, m.vec_id)) as component_id,
  m.vec_id = least(m.vec_id, coalesce(low, m.vec_id)) as kept
from embeddings m left join degrees d on d.a = m.vec_id left join lowest on lowest.a = m.vec_id
"""

ORACLE["op4_source_mixing"] = f"""
with recursive docs as (
  select doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''), '\\S+')) as bigint)
      as n_tokens,
    md5('{SEED}:' || cast(doc_id as varchar) || ':' || md5(coalesce(text, ''))) as key
  from documents),
totals as (
  select source, sum(n_tokens) as tokens,
    cast(sum(n_tokens) as double) / sum(sum(n_tokens)) over () as share
  from docs group by source),
s as (select share from totals where share > 0),
aim as (
  select 0.98e0 * ln(count(*)) as target, -sum(share * ln(share)) as plain from s),
-- The last exponent whose entropy reaches the goal, rounded down.
flat(i, low, high) as (
  select 0, 0e0, 1e0
  union all
  select i + 1,
    case when h >= target then (low + high) / 2 else low end,
    case when h >= target then high else (low + high) / 2 end
  from (
    select i, low, high, target,
      (select ln(sum(pow(share, (low + high) / 2)))
         - (low + high) / 2 * sum(pow(share, (low + high) / 2) * ln(share))
           / sum(pow(share, (low + high) / 2)) from s) as h
    from flat, aim where i < 40) q),
first as (
  select case when plain >= target then 1e0
    else (select floor(low * 1e6) / 1e6 from flat where i = 40) end as a from aim),
repeats as (select max(pow(share, a - 1)) / sum(pow(share, a)) as r from s, first group by a),
-- The first exponent from there on with no source drawn more than four times, rounded up.
up(i, low, high) as (
  select 0, a, 1e0 from first
  union all
  select i + 1,
    case when r > 4 then (low + high) / 2 else low end,
    case when r > 4 then high else (low + high) / 2 end
  from (
    select i, low, high,
      (select max(pow(share, (low + high) / 2 - 1)) / sum(pow(share, (low + high) / 2)) from s) as r
    from up where i < 40) q),
power as (
  select case when r <= 4 then a else (select ceil(high * 1e6) / 1e6 from up where i = 40) end as a
  from first, repeats),
weights as (
  select source, share, greatest(ceil(tokens / {BLOCK_TOKENS}e0), 1) as blocks,
    case when share > 0 then pow(share, a) else 0 end
      / (select sum(pow(share, p.a)) from s, power p) as weight
  from totals, power),
placed as (
  select d.doc_id, d.source, n_tokens, key, weight,
    case when share > 0 then round(weight / share, 9) else 0 end as repeats,
    cast(cast('0x' || substr(key, 25, 8) as bigint) % cast(blocks as bigint) as bigint) as block
  from docs d join weights w on d.source is not distinct from w.source),
cut as (
  select *, cast(sum(n_tokens) over (partition by source, block order by key
      rows unbounded preceding) - n_tokens as bigint) as place,
    sum(n_tokens) over (partition by source, block) as held
  from placed),
drawn as (
  select *, cast(floor(repeats) + cast(place + n_tokens / 2e0 < (repeats - floor(repeats)) * held
    as int) as int) as copies from cut)
select doc_id, source, cast(copy as int) as copy, block,
  md5('{SEED}:' || coalesce(source, '') || ':' || cast(block as varchar) || ':'
    || cast(copy as varchar)) as turn,
  place, n_tokens, round(weight, 9) as weight
from (select *, unnest(range(0, copies)) as copy from drawn where copies > 0) q
"""

ORACLE["op6_benchmark_decontamination"] = f"""
with dw as (select doc_id, {_words('[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')} as w from documents),
bw as (select item_id, {_words('[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')} as w from benchmark),
windows as (
  select distinct item_id, least(len(w), 10) as n,
    list_slice(w, i, i + least(len(w), 10) - 1) as words
  from (select item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as i
        from bw where len(w) > 0) q),
places as (
  select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as i
  from dw, (select distinct n from windows) k where len(w) >= n),
hits as (
  select p.doc_id, p.i, p.n, x.item_id from places p join windows x
  on x.n = p.n and x.words = list_slice(p.w, p.i, p.i + p.n - 1)),
marked as (
  select doc_id, count(distinct place) as n_hit
  from (select doc_id, unnest(range(i, i + n)) as place from hits) q group by doc_id),
items as (
  select doc_id, count(distinct item_id) as n_items,
    string_agg(distinct cast(item_id as varchar), ',' order by cast(item_id as varchar)) as ids
  from hits group by doc_id)
select d.doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit,
  cast(coalesce(n_items, 0) as bigint) as n_items, sha256(coalesce(ids, '')) as items_sha256,
  coalesce(n_hit, 0) > 0 as contaminated
from dw d left join marked using (doc_id) left join items using (doc_id)
"""

ORACLE["op7_quotation_linking"] = f"""
with recursive {cte("mails")},
lines as (
  select conv_id, turn, line, regexp_extract(line, '^([ \\t]*>)+') as marks
  from (select conv_id, turn, unnest(string_split(text, chr(10))) as line from mails) q),
found as (
  select conv_id, turn, len(regexp_replace(marks, '[^>]', '', 'g')) as depth,
    trim(regexp_replace(lower(substr(line, len(marks) + 1)), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))
      as passage
  from lines),
own as (select distinct conv_id, turn, passage from found where depth = 0 and passage <> ''),
quoted as (select * from found where depth > 0 and passage <> ''),
votes as (
  select q.conv_id, q.turn, q.depth, (select max(o.turn) from own o
    where o.conv_id = q.conv_id and o.passage = q.passage and o.turn < q.turn) as origin
  from quoted q),
sums as (
  select conv_id, turn, count(*) as n_quoted, count(origin) as n_linked from votes group by 1, 2),
parents as (
  select conv_id, turn, origin as parent from (
    select conv_id, turn, origin, row_number() over (partition by conv_id, turn
      order by count(*) desc, origin desc) as rank
    from votes where depth = 1 and origin is not null group by 1, 2, 3) q where rank = 1),
up(conv_id, turn, thread, level) as (
  select conv_id, turn, parent, 1 from parents
  union all
  select u.conv_id, u.turn, p.parent, u.level + 1 from up u join parents p
  on p.conv_id = u.conv_id and p.turn = u.thread),
tops as (
  select conv_id, turn, arg_max(thread, level) as thread, max(level) as level from up group by 1, 2)
select m.conv_id, m.turn, m.role, p.parent, coalesce(t.thread, m.turn) as thread,
  cast(coalesce(t.level, 0) as int) as level, cast(coalesce(n_quoted, 0) as bigint) as n_quoted,
  cast(coalesce(n_linked, 0) as bigint) as n_linked,
  regexp_replace(array_to_string(list_filter(string_split(m.text, chr(10)),
    lambda x: not regexp_matches(x, '^([ \\t]*>)+')), chr(10)), '^\\s+|\\s+$', '', 'g') as text
from mails m left join sums s using (conv_id, turn) left join parents p using (conv_id, turn)
left join tops t using (conv_id, turn)
"""

ORACLE["op8_temporal_url_lists"] = f"""
with {cte("captures", "list_entries")},
days as (
  select list, lower(domain) as domain, day, bool_and(listed) as listed from list_entries
  where list is not null and domain is not null and day is not null and listed is not null
  group by 1, 2, 3),
changes as (
  select * from (select *, coalesce(lag(listed) over (partition by list, domain order by day), false)
    as before from days) q where listed <> before),
valid as (
  select * from (select list, domain, listed, day as since,
    lead(day) over (partition by list, domain order by day) as until from changes) q where listed),
hosts as (
  select page_id, url, fetched, nullif(regexp_replace(lower(regexp_extract(url,
    '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#@]*@)?([^/?#:@]+)', 2)), '\\.$', ''), '') as host
  from captures),
active as (
  select h.host, h.fetched, string_agg(distinct v.list, ',' order by v.list) as lists
  from (select distinct host, fetched from hosts where host is not null) h join valid v
  on (h.host = v.domain or ends_with(h.host, '.' || v.domain))
    and h.fetched >= v.since and (v.until is null or h.fetched < v.until)
  group by 1, 2)
select page_id, url, h.fetched, h.host, coalesce(lists, '') as lists, lists is not null as blocked
from hosts h left join active a on a.host = h.host and a.fetched = h.fetched
"""

ORACLE["op9_minhash_near_dedup"] = f"""
with recursive dw as (select doc_id, {_words('[^\\x20\\x09-\\x0D]+')} as w from documents),
shingles as (
  select distinct doc_id, list_slice(w, i, i + 4) as shingle
  from (select doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) as i
        from dw where len(w) > 0) q),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
links as (
  select p.doc_id as a, q.doc_id as b from shingles p join shingles q
  on p.shingle = q.shingle and p.doc_id <> q.doc_id
  join sizes s on s.doc_id = p.doc_id join sizes t on t.doc_id = q.doc_id
  group by p.doc_id, q.doc_id, s.n, t.n having 100 * count(*) >= 75 * (s.n + t.n - count(*))),
{_REACH}
select d.doc_id, cast(coalesce(n, 0) as bigint) as n_shingles,
  least(d.doc_id, coalesce(low, d.doc_id)) as component_id,
  d.doc_id = least(d.doc_id, coalesce(low, d.doc_id)) as kept
from dw d left join sizes using (doc_id) left join lowest on lowest.a = d.doc_id
"""

ORACLE["op11_fill_in_middle"] = """
with units as (
  select doc_id, coalesce(text, '') as text,
    regexp_extract_all(coalesce(text, ''), '[^\\n]*\\n|[^\\n]+') as u,
    sha256('7:' || coalesce(cast(doc_id as varchar), '')) as d from documents),
h as (
  select *, len(u) as n, ('0x' || substr(d, 1, 8))::ubigint as h1,
    ('0x' || substr(d, 9, 8))::ubigint as h2, ('0x' || substr(d, 17, 8))::ubigint as h3,
    ('0x' || substr(d, 25, 8))::ubigint as h4 from units),
cut as (
  select *, least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as b,
    case when text = '' or regexp_matches(text, '<[PSM]>') or h3 % 100 >= 100 then 'plain'
      when h4 % 100 < 50 then 'spm' else 'psm' end as form from h),
parts as (
  select *, coalesce(array_to_string(u[1:a], ''), '') as p,
    coalesce(array_to_string(u[a + 1:b], ''), '') as m,
    coalesce(array_to_string(u[b + 1:n], ''), '') as s from cut)
select doc_id, cast(n as bigint) as n, form,
  case when form <> 'plain' then length(p) end as prefix_chars,
  case when form <> 'plain' then length(m) end as middle_chars,
  sha256(case form when 'plain' then text when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m
    else '<S>' || s || '<P>' || p || '<M>' || m end) as output_sha256,
  sha256(text) as restored_sha256
from parts
"""
