"""The operators' results in SQL for DuckDB, where SQL can express them."""

from __future__ import annotations

OP1 = r"""
with d as materialized (
  select doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) as ws
  from documents
),
b as materialized (
  select item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws
  from benchmark
),
i as (select item_id, ws, least(len(ws), 10) as n from b where len(ws) > 0),
windows as materialized (
  select distinct item_id, n, array_to_string(ws[k : k + n - 1], ' ') as gram
  from (select *, unnest(range(1, len(ws) - n + 2)) as k from i)
),
sizes as (select distinct n from windows),
grams as (
  select doc_id, n, k, array_to_string(ws[k : k + n - 1], ' ') as gram
  from (select doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) as k from d, sizes where len(ws) >= n)
),
hits as materialized (
  select distinct g.doc_id, w.item_id, g.n, g.k from grams g join windows w on g.n = w.n and g.gram = w.gram
),
covered as (
  select doc_id, count(distinct p) as n_hit
  from (select doc_id, unnest(range(k, k + n)) as p from hits) group by doc_id
),
named as (
  select doc_id, count(*) as n_items, string_agg(item_id::varchar, ',' order by item_id::varchar) as ids
  from (select distinct doc_id, item_id from hits) group by doc_id
)
select d.doc_id, len(d.ws)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit,
  coalesce(n_items, 0)::bigint as n_items, sha256(coalesce(ids, '')) as items_sha256,
  coalesce(n_hit, 0) > 0 as contaminated
from d left join covered using (doc_id) left join named using (doc_id)
"""

OP8 = """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as vec
  from embeddings
  where embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
),
scored as (
  select q.vec_id as query_id, d.vec_id, list_inner_product(q.vec, d.vec)::bigint as score
  from v q, v d
  where q.vec_id % 50 = 0 and d.vec_id <> q.vec_id
),
ranked as (
  select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from scored
)
select query_id, rank, vec_id, score from ranked where rank <= 5
"""

OP10 = r"""
with d as materialized (
  select doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) as ws from documents
),
w as materialized (
  select doc_id, k, md5(array_to_string(ws[k : k + 34], ' ')) as g
  from (select doc_id, ws, unnest(range(1, len(ws) - 33)) as k from d where len(ws) >= 35)
),
repeated as (select g from w group by g having count(*) > 1),
covered as materialized (
  select distinct doc_id, unnest(range(k, k + 35)) as p from w where g in (select g from repeated)
),
left_over as (
  select x.doc_id, string_agg(x.word, ' ' order by x.p) as kept, count(*) as n
  from (select doc_id, unnest(ws) as word, generate_subscripts(ws, 1) as p from d) x
  anti join covered c on x.doc_id = c.doc_id and x.p = c.p
  group by x.doc_id
)
select d.doc_id, len(d.ws)::bigint as n_words, (len(d.ws) - coalesce(l.n, 0))::bigint as n_removed,
  sha256(coalesce(l.kept, '')) as kept_sha256
from d left join left_over l on d.doc_id = l.doc_id
"""



def _add(key: str, cost: int, label: str) -> str:
    """A state's key (cost in nine digits, audit) after one more edit; '~' is out of reach."""
    return (
        f"case when {key} = '~' then '~' else lpad((left({key}, 9)::bigint + {cost})::varchar, 9, '0') "
        f"|| substr({key}, 10) || '{label}' end"
    )


def _with_inserts(states: str, keep: str) -> str:
    """Keys k0 to k3 of a table with any inserts after them."""
    two = f"least(k2, {_add('k0', 3, 'I')}, {_add('k1', 3, 'I')})"
    return (
        f"select {keep}, k0, k1, least(h2, {_add('k3', 3, 'I')}) as k2, least(k3, {_add('h2', 3, 'I')}) as k3 "
        f"from (select *, {two} as h2 from {states})"
    )


def _used(state: int) -> str:
    """Key of `state` after a row: by delete, by keep or by change of role."""
    came = {0: [], 1: [(0, "s")], 2: [(0, "u"), (1, "u"), (3, "u")], 3: [(2, "a")]}[state]
    found = [_add(f"k{state}", 4, "D")]
    for source, role in came:
        kept = f"case when kind = '{role}' then {_add(f'k{source}', 0, 'K')} else '~' end"
        found.append(f"case when must then '~' when cut then {_add('(' + kept + ')', 3, '')} else {kept} end")
        if state > 1:
            changed = _add(f"k{source}", 3, "R")
            found.append(f"case when must then '~' when cut then {_add('(' + changed + ')', 3, '')} else {changed} end")
    return "least(" + ", ".join([*found, "'~'"]) + ")"


OP13 = rf"""
with recursive t as (
  select list_transform(range(256), lambda n: list_reduce(range(8), lambda c, k:
    case when c % 2 = 1 then xor(c // 2, 3988292384) else c // 2 end, n::bigint)) as crc
),
c as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
    coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as name
  from conversations
),
f as (
  select c.*, xor(list_reduce(list_transform(string_split(name, ''), lambda x: ascii(x)::bigint),
    lambda r, b: xor(r // 256, t.crc[xor(r % 256, b) + 1]), 4294967295::bigint), 4294967295) % 20 as fault
  from c, t
),
d as (
  select conv_id, turn, case when fault = 4 then 'user' else role end as role,
    case fault when 1 then '' when 2 then translate(text, '.!?', '') else text end as text,
    unnest(case when fault = 3 then [1, 2] else [1] end) as copy
  from f where fault <> 0
),
o as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, text, copy) as i from d
),
m as materialized (
  select conv_id, i, turn, role, text, left(role, 1) as kind,
    not regexp_matches(text, '[^ 	-]') as blank,
    row_number() over (partition by conv_id, role, text order by i) > 1 as again,
    not regexp_matches(text, '[.!?][ 	-]*$') as open,
    lag(left(role, 1)) over (partition by conv_id order by i) || left(role, 1) as pair
  from o
),
r as materialized (
  select *, blank or again as must, not blank and not again and open as cut from m
),
ids as (select distinct conv_id from conversations),
steps as (
  select conv_id, 0::bigint as i, '000000000' as k0, '~' as k1, '~' as k2, '~' as k3 from ids
  union all
  select s.conv_id, s.i + 1, {_used(0)}, {_used(1)}, {_used(2)}, {_used(3)}
  from ({_with_inserts('steps', 'conv_id, i')}) s join r on r.conv_id is not distinct from s.conv_id and r.i = s.i + 1
),
ends as (
  select s.conv_id, least(k0, k3) as k from ({_with_inserts('steps', 'conv_id, i')}) s
  join (select ids.conv_id, count(r.i) as n from ids left join r on r.conv_id is not distinct from ids.conv_id group by 1) e
    on e.conv_id is not distinct from s.conv_id and s.i = e.n
),
best as materialized (select conv_id, left(k, 9)::bigint as cost, substr(k, 10) as audit from ends),
walk as (
  select conv_id, audit, 0::bigint as p, 0::bigint as i, 0 as q, null::varchar as said from best
  union all
  select w.conv_id, audit, p + 1, case when label = 'I' then w.i else w.i + 1 end,
    case when label = 'D' then q when label = 'K' and kind = 's' then 1 when q = 2 then 3 else 2 end,
    case when label = 'D' then said
      else coalesce(said || chr(10), '') || case when label = 'K' then role when q = 2 then 'assistant' else 'user' end
        || ':' || case when label = 'I' then '' else text end end
  from (select *, substr(audit, (p + 1)::bigint, 1) as label from walk where p < length(audit)) w
  left join r on r.conv_id is not distinct from w.conv_id and r.i = w.i + 1
),
counts as (
  select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count_if(blank) as blank,
    count_if(again and not blank) as duplicate, count_if(cut) as truncated,
    count_if(pair is not null and pair not in ('su', 'ua', 'au')) as illegal
  from r group by conv_id
)
select b.conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0)::bigint as blank,
  coalesce(duplicate, 0)::bigint as duplicate, coalesce(truncated, 0)::bigint as truncated,
  coalesce(illegal, 0)::bigint as illegal, cost, b.audit, sha256(coalesce(said, '')) as repaired_sha256
from best b join walk w on w.conv_id is not distinct from b.conv_id and p = length(b.audit)
left join counts n on n.conv_id is not distinct from b.conv_id
"""

ORACLES = {
    "op1_decontaminate": OP1,
    "op8_voronoi_knn": OP8,
    "op10_fm_substring_dedup": OP10,
    "op13_conversation_repair": OP13,
}
