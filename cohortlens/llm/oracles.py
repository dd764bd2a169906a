"""DuckDB SQL of the queries that SQL can express on whole tables: the
contract word for word, by plain grouping and joining, without the methods
the operators use."""

from __future__ import annotations

WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"

OP1 = f"""
with docs as (select doc_id, {WORDS.format("coalesce(text, '')")} as w from documents),
win as (
  select doc_id, i, array_to_string(w[i:i + 12], ' ') as words
  from (select doc_id, w, unnest(range(1, len(w) - 11)) as i from docs)),
firsts as (select words, min(doc_id) as first_doc from win group by words),
gone as (
  select distinct doc_id, unnest(range(i, i + 13)) as p
  from win join firsts using (words) where first_doc < doc_id),
placed as (select doc_id, unnest(range(1, len(w) + 1)) as p, unnest(w) as word from docs),
kept as (
  select doc_id, string_agg(word, ' ' order by p) as t, count(*) as n
  from placed anti join gone using (doc_id, p) group by doc_id)
select d.doc_id, cast(len(d.w) as bigint) as n_words, cast(len(d.w) - coalesce(k.n, 0) as bigint) as n_removed,
       sha256(coalesce(k.t, '')) as kept_sha256
from docs d left join kept k using (doc_id)
"""

OP3 = """
with docs as (
  select doc_id, lower(hex(encode(coalesce(text, '')))) as h, octet_length(encode(coalesce(text, ''))) as n from documents),
win as (select doc_id, i, substring(h, 2 * i + 1, 100) as s from (select doc_id, h, unnest(range(0, n - 49)) as i from docs)),
firsts as (select s, min(doc_id) as first_doc from win group by s),
hit as (select doc_id, i from win join firsts using (s) where first_doc < doc_id),
marked as (
  select doc_id, i, case when i - lag(i) over (partition by doc_id order by i) <= 50 then 0 else 1 end as fresh from hit),
numbered as (select doc_id, i, sum(fresh) over (partition by doc_id order by i) as run from marked),
runs as (select doc_id, min(i) as a, max(i) + 50 as b from numbered group by doc_id, run),
cuts as (select doc_id, a, b, lag(b, 1, 0) over (partition by doc_id order by a) as prev from runs),
pieces as (
  select c.doc_id, string_agg(substring(d.h, 2 * cast(prev as bigint) + 1, 2 * cast(a - prev as bigint)), '' order by a)
           || any_value(d.h)[2 * max(b) + 1:] as h,
         sum(b - a) as removed, count(*) as n_spans
  from cuts c join docs d using (doc_id) group by c.doc_id)
select d.doc_id, cast(d.n as bigint) as n_bytes, cast(coalesce(p.removed, 0) as bigint) as n_removed,
       cast(coalesce(p.n_spans, 0) as bigint) as n_spans, sha256(unhex(coalesce(p.h, d.h))) as kept_sha256
from docs d left join pieces p using (doc_id)
"""

_REACH = """
reach as (
  select doc, doc as root from nodes
  union
  select e.b as doc, r.root from reach r join edges e on e.a = r.doc),
comp as (select doc, min(root) as component_id from reach group by doc)"""

OP9 = f"""
with recursive docs as (
  select doc_id, {WORDS.format("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} as w
  from documents),
shingles as (
  select distinct doc_id, array_to_string(w[i:i + 4], ' ') as s
  from (select doc_id, w, unnest(range(1, greatest(len(w) - 3, least(len(w), 1) + 1))) as i from docs)),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
pairs as (
  select a.doc_id as a, b.doc_id as b, count(*) as o
  from shingles a join shingles b on a.s = b.s and a.doc_id < b.doc_id group by a.doc_id, b.doc_id),
links as (
  select p.a, p.b from pairs p join sizes x on x.doc_id = p.a join sizes y on y.doc_id = p.b
  where 100 * o >= 75 * (x.n + y.n - o)),
edges as (select a, b from links union all select b, a from links),
nodes as (select doc_id as doc from documents),
{_REACH}
select d.doc_id, cast(coalesce(s.n, 0) as bigint) as n_shingles, c.component_id
from docs d join comp c on c.doc = d.doc_id left join sizes s on s.doc_id = d.doc_id
"""

OP5 = f"""
with recursive vecs as (
  select vec_id, cast(embedding as double[]) as v from embeddings
  where embedding is not null and len([x for x in embedding if x is null or isnan(x) or isinf(x)]) = 0
    and len([x for x in embedding if x <> 0]) > 0),
links as (
  select a.vec_id as a, b.vec_id as b from vecs a join vecs b
    on a.vec_id < b.vec_id and len(a.v) = len(b.v) and list_cosine_similarity(a.v, b.v) >= 0.9),
edges as (select a, b from links union all select b, a from links),
nodes as (select vec_id as doc from embeddings),
{_REACH},
counts as (select a, count(*) as n from edges group by a)
select e.vec_id, cast(coalesce(n, 0) as bigint) as n_links, component_id, e.vec_id = component_id as kept
from embeddings e join comp c on c.doc = e.vec_id left join counts k on k.a = e.vec_id
"""

_ASSIGN = r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""


def _kind(rank: int, kind: str, pattern: str, group: int, least: int) -> str:
    return f"""
  select doc_id, {rank} as rank, '{kind}' as kind, {least} as least, string_split_regex(t, '{pattern}') as gaps,
         regexp_extract_all(t, '{pattern}', 0) as hits, regexp_extract_all(t, '{pattern}', {group}) as parts
  from docs where regexp_matches(t, '{pattern}')"""


OP10 = f"""
with docs as (select doc_id, coalesce(text, '') as t from documents),
found as ({_kind(0, "assign", _ASSIGN, 2, 8)}
  union all {_kind(1, "access", "AKIA[A-Z0-9]+", 0, 16)}
  union all {_kind(2, "hex", "[0-9a-f]{32,}", 0, 32)}),
numbered as (select *, unnest(range(1, len(hits) + 1)) as i from found),
spans as (
  select doc_id, rank, kind, length(hits[i]) as size,
         cast(list_sum([length(g) for g in gaps[1:i]]) + coalesce(list_sum([length(h) for h in hits[1:i - 1]]), 0) as bigint) as a
  from numbered where length(parts[i]) >= least),
joined as (
  select doc_id, sum(case when rank = 0 then 1 else 0 end) as n0, sum(case when rank = 1 then 1 else 0 end) as n1,
         sum(case when rank = 2 then 1 else 0 end) as n2,
         string_agg(kind || ':' || a || ':' || (a + size), ',' order by a, rank) as s
  from spans group by doc_id)
select d.doc_id, cast(coalesce(n0, 0) as bigint) as n_assign, cast(coalesce(n1, 0) as bigint) as n_access,
       cast(coalesce(n2, 0) as bigint) as n_hex, sha256(coalesce(s, '')) as base_sha256, coalesce(s, '') as spans
from docs d left join joined j using (doc_id)
"""

_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PLAIN = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')".format(_LOWERED)

OP12 = f"""
with items as (select cast(item_id as varchar) as item_id, {_PLAIN} as w from benchmark),
windows as (
  select distinct item_id, least(len(w), 10) as m, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') as s
  from (select item_id, w, unnest(range(1, greatest(len(w) - 9, least(len(w), 1)) + 1)) as i from items)),
docs as (select doc_id, {_PLAIN} as w, row_number() over () as r from documents),
placed as (
  select r, i, m, array_to_string(w[i:i + m - 1], ' ') as s
  from (select r, w, m, unnest(range(1, len(w) - cast(m as int) + 2)) as i from docs, (select distinct m from windows))),
hits as (select r, i, placed.m, item_id from placed join windows using (m, s)),
covered as (
  select r, count(distinct p) as n from (select distinct r, unnest(range(i, i + cast(m as int))) as p from hits) group by r),
named as (
  select r, count(*) as n, string_agg(item_id, ',' order by item_id) as s
  from (select distinct r, item_id from hits where item_id is not null) group by r)
select d.doc_id, cast(len(d.w) as bigint) as n_words, cast(coalesce(c.n, 0) as bigint) as n_hit,
       cast(coalesce(k.n, 0) as bigint) as n_items, sha256(coalesce(k.s, '')) as items_sha256, coalesce(c.n, 0) > 0 as contaminated
from docs d left join covered c using (r) left join named k using (r)
"""


def _crc32(text: str) -> str:
    """Unsigned CRC-32 of an ASCII string (fixed values: the polynomial and start of CRC-32)."""
    return (f"xor(list_reduce(list_prepend(4294967295::bigint, [ord(c)::bigint for c in string_split({text}, '')]), lambda v, c: "
            "list_reduce(list_prepend(xor(v, c), range(8)), lambda b, i: xor(b >> 1, (b & 1) * 3988292384))), 4294967295::bigint)")


# Equal words one period apart: for periods up to 5 word by word, beyond that by sequences of 6 words.
OP13 = f"""
with given as (
  select row_number() over () as r, doc_id, {WORDS.format("coalesce(text, '')")} as w, {_crc32("cast(doc_id as varchar)")} as h from documents),
parts as (select *, len(w) as n, h // 10 as g from given),
bent as (select *, g % n as a, 1 + (n - g % n) // (3 + g % 8) as p from parts),
docs as (
  select r, doc_id, n, case when h % 10 = 0 and n > 0 then [w[1 + case when i < a then i else a + (i - a) % p end] for i in range(n)] else w end as w
  from bent),
near as (
  select r, i, q, 1 as size from (select r, w, n, unnest(range(n)) as i from docs), (select unnest(range(1, 6)) as q)
  where i + q < n and w[i + 1] = w[i + 1 + q]),
six as (select r, i, array_to_string(w[i + 1:i + 6], ' ') as s from (select r, w, unnest(range(n - 5)) as i from docs)),
equal as (
  select * from near
  union all
  select x.r, x.i, y.i - x.i as q, 6 as size from six x join six y on x.r = y.r and x.s = y.s and y.i - x.i >= 6),
islands as (select *, i - row_number() over (partition by r, q order by i) as island from equal),
stretches as (select r, q, min(i) as x, max(i) - min(i) + any_value(size) as m from islands group by r, q, island),
runs as (
  select r, x, m + q as length, min(q) as q from (select r, q, x, m from stretches where m >= q and m + q >= 12)
  group by r, x, m + q),
named as (
  select r, count(*) as n, arg_min(struct_pack(x, length, q), (-length, x, q)) as top,
         string_agg(x || ',' || length || ',' || q || chr(10), '' order by x, q) as s
  from runs group by r),
gone as (select distinct r, unnest(range(x + q, x + length)) as i from runs),
kept as (
  select r, string_agg(word, ' ' order by i) as t
  from (select r, unnest(range(n)) as i, unnest(w) as word from docs) anti join gone using (r, i) group by r)
select doc_id, coalesce(k.n, 0) as n_runs, k.top.x as start, k.top.length as length, k.top.q as period,
       1000 * k.top.length // k.top.q as exponent_milli, sha256(coalesce(k.s, '')) as runs_sha256,
       sha256(coalesce(t, '')) as collapsed_sha256
from docs left join named k using (r) left join kept using (r)
"""

OP11 = f"""
with given as (
  select conv_id, coalesce(role, '') as role, coalesce(text, '') as text, turn from conversations where conv_id is not null),
turns as (
  select conv_id, row_number() over (partition by conv_id order by turn nulls first, role, md5(length(role) || ':' || role || text)) as pos,
         dense_rank() over (order by role, text) as id, len({WORDS.format("text")}) as words
  from given),
convs as (select conv_id, cast({_crc32("cast(conv_id as varchar)")} % 4 as int) as h, conv_id - conv_id % 20 as base
          from (select distinct conv_id from turns)),
rebuilt as (
  select c.conv_id, 0 as part, t.pos, t.id from convs c join turns t on t.conv_id = c.base and t.pos <= c.h
  union all
  select c.conv_id, 1, t.pos, t.id from convs c join turns t on t.conv_id = c.conv_id and t.pos > c.h),
paths as (
  select conv_id, coalesce(path, []) as path
  from convs left join (select conv_id, list(id order by part, pos) as path from rebuilt group by conv_id) using (conv_id)),
members as (select conv_id, d, path[1:d] as node, d = len(path) as ends from (select *, unnest(range(len(path) + 1)) as d from paths)),
nodes as (
  select node, d, min(conv_id) as conv_id, count(*) as n,
         coalesce(string_agg(cast(conv_id as varchar), ',' order by conv_id) filter (where ends), '') as ended
  from members group by node, d),
children as (select node[1:d - 1] as node, count(*) as n from nodes where d > 0 group by all),
words_of as (select distinct id, words from turns),
gains as (
  select n.node, n.d, (n.n - 1) * coalesce(w.words, 0) as gain, case when c.n is null then 1 else 0 end as leaf
  from nodes n left join words_of w on w.id = n.node[n.d] left join children c on c.node = n.node),
below as (
  select node[1:u] as node, sum(gain) as saved, sum(leaf) as leaves from (select *, unnest(range(d + 1)) as u from gains) group by all)
select n.conv_id, cast(n.d as bigint) as depth, p.conv_id as parent_conv_id, n.n as n_convs, coalesce(c.n, 0) as n_children,
       cast(b.leaves as bigint) as n_leaves, cast(b.saved as bigint) as saved_tokens, sha256(n.ended) as ends_sha256
from nodes n join below b using (node) left join children c on c.node = n.node
     left join nodes p on n.d > 0 and p.node = n.node[1:n.d - 1] and p.d = n.d - 1
"""
