"""DuckDB SQL for the queries that SQL can express, written from the contracts."""

CONTAMINATION = r"""
with doc as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[0-9a-z\x{80}-\x{10FFFF}]+') as w from documents),
item as (
  select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[0-9a-z\x{80}-\x{10FFFF}]+') as w from benchmark),
windows as (
  select distinct item_id, least(13, len(w)) as size, array_to_string(w[i : i + least(13, len(w)) - 1], ' ') as words
  from (select item_id, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) as i from item where len(w) > 0)),
place as (
  select doc_id, s.size, i, array_to_string(w[i : i + s.size - 1], ' ') as words
  from (select doc_id, w, size, unnest(range(1, len(w) - size + 2)) as i
        from doc, (select distinct size from windows) where len(w) >= size) s),
found as (select p.doc_id, p.i, p.size, x.item_id from place p join windows x on p.size = x.size and p.words = x.words),
hits as (
  select doc_id, count(distinct pos) as n_hit
  from (select doc_id, unnest(range(i, i + size)) as pos from (select distinct doc_id, i, size from found)) group by doc_id),
items as (
  select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as list
  from (select distinct doc_id, item_id::varchar as item from found) group by doc_id)
select d.doc_id, len(d.w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
       sha256(coalesce(list, '')) as items_sha256,
       coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(d.w) as contaminated
from doc d left join hits using (doc_id) left join items using (doc_id)
"""

WARC = r"""
with page as (
  select page_id, coalesce(html, '') as payload, sha1(coalesce(html, '')) as hex from pages),
newest as (select payload, max(page_id) as page_id from page group by payload)
select p.page_id, strlen(p.payload) as payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + ((('0x' || substr(hex, 1 + 5 * (k // 4)::int, 5))::int >> (15 - 5 * (k % 4))::int) & 31), 1)), '') as payload_digest,
       case when p.page_id = n.page_id then 'response' else 'revisit' end as record_type,
       case when p.page_id <> n.page_id then n.page_id end as refers_to
from page p join newest n using (payload)
"""

COVER_TREE = r"""
with recursive v as (
  select vec_id, label, embedding::double[] as e from embeddings),
link as (
  select a.vec_id as a, b.vec_id as b from v a join v b on a.label = b.label and a.vec_id <> b.vec_id
  where list_cosine_similarity(a.e, b.e) >= 0.98),
reach(vec_id, other) as (
  select vec_id, vec_id from v
  union select r.vec_id, l.b from reach r join link l on r.other = l.a),
part as (select vec_id, min(other) as component_id from reach group by vec_id)
select p.vec_id, (select count(*) from link where a = p.vec_id) as n_links, component_id,
       p.vec_id = component_id as kept
from part p
"""

TOOL_CALLS = r"""
with turns as (
  select conv_id, turn, role, text, length(text) as size, conv_id || '-' || turn as own, conv_id || '-' || (turn - 1) as last
  from conversations),
call as (
  select t.*, exists (select 1 from turns r where r.role = 'assistant' and r.last = t.own) as answered
  from turns t where role = 'user'),
chain as (
  select *, turn - 2 * row_number() over (partition by conv_id, turn % 2 order by turn) as island from call),
levelled as (
  select *, coalesce(sum(case when answered then 2 else 1 end) over (
    partition by conv_id, turn % 2, island order by turn rows between unbounded preceding and 1 preceding), 0) as level
  from chain)
select conv_id, turn, 'call' as kind, own as call_id,
       case when answered then 'linked' else 'unanswered' end as status, level::bigint as level,
       case when size % 5 = 0 then array_to_string(list_filter([
              case when size < 1 or size > 600 then 'range body' end,
              case when turn % 8 = 6 then 'unknown mark' end], lambda x: x is not null), ',')
            else case when size % 50 < 1 or size % 50 > 40 then 'range limit' else '' end end as errors,
       case when size % 5 = 0 then '{"arguments":{"body":' || to_json(text)
              || case when turn % 8 = 6 then ',"mark":' || turn else '' end
              || ',"pinned":' || (turn % 4 = 0)::varchar || '},"id":"' || own || '","name":"note","type":"call"}'
            else '{"arguments":{"limit":' || (size % 50) || ',"query":' || to_json(text) || '},"id":"' || own
              || '","name":"search","type":"call"}' end as message
from levelled
union all
select t.conv_id, t.turn, 'result', t.last, case when c.own is null then 'orphan' else 'linked' end,
       (c.level + 1)::bigint, null, '{"content":' || to_json(t.text) || ',"id":"' || t.last || '","type":"result"}'
from turns t left join levelled c on c.own = t.last where t.role = 'assistant'
"""


_SPACES = r"\x20\x09-\x0D"


def _edited(state: int) -> str:
    """The lightest completion of a suffix after an edit of its first row in ``state`` (w0 to w3: of the rows after it)."""
    step = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
    names = {"u": "user", "a": "assistant"}
    keep = "".join(
        f", case when role[1] = '{initial}' and not gone then {{'cost': w{to}.cost + cut, 'audit': 'K' || w{to}.audit, "
        f"'lines': [role || ':' || text] || w{to}.lines}} end" for (q, initial), to in step.items() if q == state)
    rerole = "".join(
        f", case when not gone then {{'cost': w{to}.cost + 2 + cut, 'audit': 'R' || w{to}.audit, "
        f"'lines': ['{names[initial]}:' || text] || w{to}.lines}} end" for (q, initial), to in step.items() if q == state and initial in names)
    return f"list_min([{{'cost': w{state}.cost + 3, 'audit': 'D' || w{state}.audit, 'lines': w{state}.lines}}{keep}{rerole}])"


def _inserted(state: int) -> str:
    """The same with up to two inserts before the row (e0 to e3: without)."""
    one = {0: 2, 1: 2, 2: 3, 3: 2}[state]
    two = {2: 3, 3: 2}[one]
    name = {2: "user", 3: "assistant"}
    return (f"list_min([e{state}, {{'cost': e{one}.cost + 2, 'audit': 'I' || e{one}.audit, 'lines': ['{name[one]}:'] || e{one}.lines}}, "
            f"{{'cost': e{two}.cost + 4, 'audit': 'II' || e{two}.audit, 'lines': ['{name[one]}:', '{name[two]}:'] || e{two}.lines}}])")


TURN_REPAIR = rf"""
with recursive given as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
         coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as named from conversations),
fault as (
  select *, xor(list_reduce(list_transform(range(0, len(named) + 1), lambda i: case when i = 0 then 4294967295 else ord(named[i]) end),
                            lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0],
                                                     lambda x, k: case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end)),
                4294967295::bigint) % 20 as f from given),
damaged as (
  select conv_id, turn, case when f = 4 then 'user' else role end as role,
         case when f = 1 then '' when f = 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
         unnest(range(case when f = 0 then 0 when f = 3 then 2 else 1 end)) as copy from fault),
ordered as (
  select conv_id, turn, role, text, row_number() over (partition by conv_id order by turn nulls first, role, text) as i from damaged),
placed as (
  select *, not regexp_matches(text, '[^{_SPACES}]') as blank, min(i) over (partition by conv_id, role, text) < i as again,
         not regexp_matches(text, '[.!?][{_SPACES}]*$') as cut,
         lag(role[1]) over (partition by conv_id order by i) as last from ordered),
counts as (
  select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, sum((blank)::int)::bigint as blank,
         sum((not blank and again)::int)::bigint as duplicate, sum((not blank and not again and cut)::int)::bigint as truncated,
         coalesce(sum((last || role[1] not in ('su', 'ua', 'au'))::int), 0)::bigint as illegal, max(i) as n from placed group by conv_id),
walk as (
  select conv_id, n as i, {{'cost': 0::bigint, 'audit': '', 'lines': []::varchar[]}} as w0,
         {{'cost': 4::bigint, 'audit': 'II', 'lines': ['user:', 'assistant:']}} as w1,
         {{'cost': 2::bigint, 'audit': 'I', 'lines': ['assistant:']}} as w2, {{'cost': 0::bigint, 'audit': '', 'lines': []::varchar[]}} as w3
  from counts
  union all
  select conv_id, i - 1, {_inserted(0)}, {_inserted(1)}, {_inserted(2)}, {_inserted(3)}
  from (select conv_id, i, {_edited(0)} as e0, {_edited(1)} as e1, {_edited(2)} as e2, {_edited(3)} as e3
        from (select w.*, p.role, p.text, p.blank or p.again as gone, p.cut::int as cut
              from walk w join placed p on w.conv_id is not distinct from p.conv_id and w.i = p.i))),
done as (select conv_id, w0 from walk where i = 0)
select g.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
       coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, coalesce(w0.cost, 0) as cost,
       coalesce(w0.audit, '') as audit, sha256(coalesce(array_to_string(w0.lines, chr(10)), '')) as repaired_sha256
from (select distinct conv_id from given) g left join counts c on g.conv_id is not distinct from c.conv_id
left join done d on g.conv_id is not distinct from d.conv_id
"""


def _round(k: int) -> str:
    """CTEs of one round: the nearest entries under book{k}, and book{k + 1}."""
    return f"""
near{k} as materialized (
  select vec_id, p, min({{'d': list_sum(list_transform(range(1, len(q) + 1), lambda i: (q[i] - c[i]) * (q[i] - c[i])))::bigint, 'e': e}}) as n, any_value(q) as q
  from part join book{k} using (p) group by vec_id, p),
sum{k} as (
  select p, e, i, sum(x)::bigint as s, count(*) as n
  from (select p, n.e as e, unnest(q) as x, unnest(range(len(q))) as i from near{k}) group by p, e, i),
book{k + 1} as materialized (
  select b.p, b.e, coalesce(m.c, b.c) as c from book{k} b left join (
    select p, e, list((s - ((s % n) + n) % n) // n order by i) as c from sum{k} group by p, e) m using (p, e)),"""


VECTOR_CODES = f"""
with kept as (
  select vec_id, label, list_transform(embedding, lambda x: floor(x::double * 4096)::bigint) as v from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
part as materialized (
  select vec_id, label, p, v[p * (len(v) // 8) + 1 : (p + 1) * (len(v) // 8)] as q from kept, range(8) t(p)),
book0 as materialized (
  select p, row_number() over (partition by p order by vec_id) - 1 as e, q as c from part
  where vec_id in (select vec_id from kept order by vec_id limit 16)),
{"".join(_round(k) for k in range(7))}
coded as (
  select vec_id, label, string_agg(printf('%02x', n.e), '' order by p) as code, sum(n.d)::bigint as error
  from near6 join (select vec_id, label from kept) using (vec_id) group by vec_id, label),
labels_ as (select label, sum(error)::bigint as label_error from coded group by label)
select vec_id, code, error, label_error,
       (select sha256(string_agg(array_to_string(c, ','), ',' order by p, e)) from book6) as codebooks_sha256
from coded c join labels_ l on c.label is not distinct from l.label
"""

FAIR_MIX = rf"""
with doc as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^{_SPACES}]+')) as size from documents),
src as (
  select source, sum(size)::bigint as source_size, row_number() over (order by source nulls last) as number from doc group by source),
limited as (select *, [5, 2, 1][(number - 1) % 3 + 1] as weight, 3 * source_size as most from src),
line as (
  select *, sum(most) over w - most as above, sum(weight) over w - weight as above_weight
  from limited window w as (order by most / weight, number)),
level as (select max(((select sum(size) from doc) - above)::double / ((select sum(weight) from limited) - above_weight)::double) as level from line),
queued as (
  select doc_id, d.source, size, source_size, number, least(most::double, level * weight) as target, row_number() over () as row,
         sum(size) over (partition by number order by md5('42:' || doc_id), doc_id, size rows unbounded preceding) as stop
  from doc d join limited l on d.source is not distinct from l.source, level),
copies as (
  select *, round * source_size + stop - size as a, round * source_size + stop as b, floor(target)::bigint as t
  from queued, range(3) r(round)),
pieces as (
  select row, number, target, size, b as stop from copies where not (a < t and t < b)
  union all select row, number, target, t - a, t from copies where a < t and t < b
  union all select row, number, target, b - t, b from copies where a < t and t < b),
served as (
  select row, size, sum(size) over (order by stop::double / target, number, stop rows unbounded preceding) as so_far
  from pieces where size > 0),
got as (select row, sum(greatest(least(size, (select sum(size) from doc) - (so_far - size)), 0))::bigint as taken from served group by row)
select doc_id, size, source_size, target, coalesce(taken, 0) as taken, source from queued left join got using (row)
"""

SQL = {
    "op4_contamination": CONTAMINATION,
    "op6_warc": WARC,
    "op7_cover_tree": COVER_TREE,
    "op10_tool_calls": TOOL_CALLS,
    "op11_turn_repair": TURN_REPAIR,
    "op12_vector_codes": VECTOR_CODES,
    "op13_fair_mix": FAIR_MIX,
}
