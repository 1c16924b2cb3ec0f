"""The registered queries in SQL, written independently of the Spark plans.

Common table expressions are put together per query; `sql(body, *names)` adds
the ones `body` needs.
"""

from __future__ import annotations

import re

from dataclasses import dataclass

# Fixed values, stated here anew so that a wrong entry in the package shows.
LEADING_FORMS = ("pt",)
TRAILING_FORMS = (
    "inc", "incorporated", "corp", "corporation", "co", "company", "ltd", "limited", "llc", "plc",
    "lp", "llp", "gmbh", "ag", "nv", "bv", "sa", "spa", "pte", "pt", "tbk", "s a", "s p a",
)
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


@dataclass(frozen=True)
class Spec:
    flag: str
    label: str
    note: str


BASE_SPEC = Spec("has_sbti", "SBTi", "Primary source: SBTi company dataset")
MEMBER_SPECS = (
    Spec(
        "has_re100", "RE100 manual list",
        "Manual initiative source: RE100; RE100 file indicates a partial first100 subset",
    ),
    Spec("has_ev100", "EV100 manual list", "Manual initiative source: EV100"),
    Spec("has_ep100", "EP100 manual list", "Manual initiative source: EP100"),
)

ACCESSED = "2026-01-31"


def normal(x: str) -> str:
    lowered = f"replace(lower(strip_accents(coalesce({x}, ''))), '&', ' and ')"
    return f"trim(regexp_replace({lowered}, '[^a-z0-9]+', ' ', 'g'))"


def without_forms(x: str) -> str:
    front = f"regexp_replace({x}, '^(?:(?:{'|'.join(LEADING_FORMS)})(?: |$))+', '')"
    return f"trim(regexp_replace({front}, '(?:(?:^| )(?:{'|'.join(TRAILING_FORMS)}))+$', ''))"


def clean(x: str) -> str:
    return f"coalesce(nullif({without_forms(normal(x))}, ''), {normal(x)})"


def code(prefix: str, x: str) -> str:
    return f"concat('{prefix}', case when length(cast({x} as varchar)) < 9 then lpad(cast({x} as varchar), 9, '0') else cast({x} as varchar) end)"


def sentences(table: str, text: str, columns: str) -> str:
    pieces = f"string_split_regex({text}, '[.\\n|]+')"
    return (
        f"select {columns}, unnest(range(len({pieces}))) as pos, unnest({pieces}) as sentence "
        f"from {table}"
    )


CTES: dict[str, str] = {
    "entity": f"""
        select p_partkey + 1 as row_id,
               case when p_size = 50 then '' else {code('E', 'p_partkey')} end as lei, legal_name,
               {clean('legal_name')} as legal_name_clean,
               case when p_size = 19 then null else concat('Nation_', p_partkey % 25) end as country
        from (select p_partkey, p_size, concat(
                  case when p_size % 8 = 4 then 'PT ' else '' end,
                  case when p_size % 3 = 0
                       then replace(concat(p_name, ' ', p_brand, ' ', p_type), 'e', 'é')
                       else concat(p_name, ' ', p_brand, ' ', p_type) end,
                  case p_size % 8 when 0 then ', Inc.' when 1 then ' S.p.A.' when 2 then ' GmbH'
                       when 3 then ' & Co. Ltd' when 5 then ' Tbk' when 6 then ''
                       else ' Holdings' end) as legal_name
              from part) p""",
    "source": f"""
        select p_partkey as ord, {code('S', 'p_partkey')} as source_id,
               case when p_size = 7 then '***' when p_size = 13 then '0zq nobody'
                    when p_partkey % 3 = 0 then concat(p_brand, ' ', p_name, ' ', p_type)
                    when p_partkey % 3 = 1 then concat(p_name, ' ', p_brand, ' ',
                         substr(p_type, 1, length(p_type) - 1), ' Inc')
                    when p_size % 2 = 0 then concat(p_name, ' ', p_brand, ' ', p_type, ' group')
                    else concat(p_name, ' ', p_brand, ' ', p_type, ' Ltd') end as source_name,
               case when p_size = 20 then ''
                    when p_partkey % 2 = 0 then concat(' nation_', p_partkey % 25)
                    else concat('Land ', p_partkey % 5) end as source_country
        from part""",
    "text_entity": f"""
        select doc_id * 2147483648 + pos + 1 as row_id, concat('D-', doc_id, '-', pos) as lei,
               sentence as legal_name, {clean('sentence')} as legal_name_clean,
               upper(lang) as country
        from ({sentences('documents', 'text', 'doc_id, lang')}) d""",
    "title": """
        select page_id, url, regexp_extract(html, '<title>([^<]*)</title>', 1) as title,
               split_part(url, '/', 4) as lang from pages""",
    "title_source": f"""
        select {code('P', 'page_id')} as source_id, title as source_name, lang as source_country
        from title""",
    # matching input
    "ent": """
        select row_id, lei, legal_name, legal_name_clean as name,
               upper(trim(coalesce(country, ''))) as c, substr(legal_name_clean, 1, 1) as ch,
               split_part(legal_name_clean, ' ', 1) as tok
        from entity where trim(lei) <> ''""",
    "src": f"""
        select source_id, source_name as raw, {clean('source_name')} as name,
               upper(trim(source_country)) as c from source""",
    "named": """
        select distinct name, c, substr(name, 1, 1) as ch, split_part(name, ' ', 1) as tok
        from src where name <> ''""",
    "ent_key": """
        select 1 as lvl, c as kc, tok as kn, * from ent union all
        select 2, c, ch, * from ent union all select 3, '', tok, * from ent union all
        select 4, '', ch, * from ent union all select 5, c, '', * from ent union all
        select 6, '', '', * from ent""",
    "src_key": """
        select 1 as lvl, c as kc, tok as kn, name, c from named where c <> '' union all
        select 2, c, ch, name, c from named where c <> '' union all
        select 3, '', tok, name, c from named union all
        select 4, '', ch, name, c from named union all
        select 5, c, '', name, c from named where c <> '' union all
        select 6, '', '', name, c from named""",
    "ent_keys": "select distinct lvl, kc, kn from ent_key",
    "placed": """
        select s.name, s.c, min(s.lvl) as lvl from src_key s
        join ent_keys e on e.lvl = s.lvl and e.kc = s.kc and e.kn = s.kn group by s.name, s.c""",
    "block_size": "select lvl, kc, kn, count(*) as n from ent_key group by lvl, kc, kn",
    "block": """
        select * from (select *, row_number() over (partition by lvl, kc, kn order by row_id) as rn
                       from ent_key) e where rn <= 50""",
    "cut_of": """
        select p.name, p.c, z.n > 50 as cut from placed p
        join src_key k on p.name = k.name and p.c = k.c and p.lvl = k.lvl
        join block_size z on z.lvl = k.lvl and z.kc = k.kc and z.kn = k.kn""",
    "cand": """
        select p.name, p.c, p.lvl, b.row_id, b.lei, b.legal_name, b.name as other, k.kc, k.kn
        from placed p join src_key k on p.name = k.name and p.c = k.c and p.lvl = k.lvl
        join block b on b.lvl = k.lvl and b.kc = k.kc and b.kn = k.kn""",
    "exact": """
        select p.name, p.c, arg_min(e.lei, e.row_id) as lei,
               arg_min(e.legal_name, e.row_id) as legal_name, arg_min(e.name, e.row_id) as other
        from placed p join ent e on e.name = p.name and (p.lvl not in (1, 2, 5) or e.c = p.c)
        group by p.name, p.c""",
    "open": """
        select * from cand where other <> '' and (name, c) not in (select name, c from exact)""",
    "pair": "select distinct name, other from open",
}

# token parts of a pair, common subsequences by a bit-parallel recurrence, and scores
SCORING = {
    "part_of": """
        select name, other, array_to_string(list_sort(string_split(name, ' ')), ' ') as sa,
               array_to_string(list_sort(string_split(other, ' ')), ' ') as sb,
               list_sort(list_distinct(string_split(name, ' '))) as ta,
               list_sort(list_distinct(string_split(other, ' '))) as tb from pair""",
    "rest_of": """
        select *, array_to_string(list_filter(ta, lambda t: list_contains(tb, t)), ' ') as shared,
               array_to_string(list_filter(ta, lambda t: not list_contains(tb, t)), ' ') as x,
               array_to_string(list_filter(tb, lambda t: not list_contains(ta, t)), ' ') as y
        from part_of""",
    "job": """
        select distinct a, b from (select sa as a, sb as b from rest_of
                                   union all select x, y from rest_of) j
        where a <> '' and b <> ''""",
    "mask": """
        select a, substr(a, cast(pos as int) + 1, 1) as ch,
               sum(1::hugeint << cast(pos as int)) as m
        from (select a, unnest(range(length(a))) as pos from (select distinct a from job) d) u
        group by 1, 2""",
    "lcs": """
        select a, b, 1 as j, (1::hugeint << length(a)) - 1 as v from job
        union all
        select l.a, l.b, j + 1,
               ((v + (v & coalesce(m, 0::hugeint))) | (v - (v & coalesce(m, 0::hugeint))))
               & ((1::hugeint << length(l.a)) - 1)
        from lcs l left join mask s on s.a = l.a and s.ch = substr(l.b, l.j, 1)
        where j <= length(l.b)""",
    "common": """
        select a, b, length(a) - bit_count(v) as n from lcs where j = length(b) + 1""",
    "measured": """
        select r.name, r.other, length(sa) + length(sb) as total, coalesce(k.n, 0) as sort_n,
               length(shared) as s, length(x) as lx, length(y) as ly, coalesce(q.n, 0) as set_n
        from rest_of r left join common k on k.a = r.sa and k.b = r.sb
        left join common q on q.a = r.x and q.b = r.y""",
    "whole": """
        select *, s + lx + case when s > 0 then 1 else 0 end as la,
               s + ly + case when s > 0 then 1 else 0 end as lb from measured""",
    "score": """
        select name, other, 100.0::double * (1 - (total - 2 * sort_n) / total::double) as sort_ratio,
               case when s > 0 and (lx = 0 or ly = 0) then 100.0::double
                    when s = 0 then 100.0::double * (1 - (lx + ly - 2 * set_n) / (la + lb)::double)
                    else greatest(100.0::double * (1 - (lx + ly - 2 * set_n) / (la + lb)::double),
                                  100.0::double * (1 - (1 + lx) / (s + la)::double),
                                  100.0::double * (1 - (1 + ly) / (s + lb)::double))
               end as set_ratio
        from whole""",
}
CTES |= SCORING
CTES |= {
    "ranked": """
        select *, row_number() over (partition by name, c order by best desc, row_id) as rank
        from (select o.*, sort_ratio, set_ratio, greatest(sort_ratio, set_ratio) as best
              from open o join score s on s.name = o.name and s.other = o.other) r""",
    "walk": """
        select s.source_id, s.raw as source_name_raw, s.name as source_name_clean,
               coalesce(e.lei, case when f.best >= 85 then f.lei end, '') as matched_lei,
               coalesce(e.legal_name, case when f.best >= 85 then f.legal_name end, '')
                   as matched_legal_name,
               coalesce(e.other, case when f.best >= 85 then f.other end, '')
                   as matched_legal_name_clean,
               case when e.name is not null then 100.0 else f.best end as match_score,
               case when e.name is not null then 'exact'
                    when f.name is not null then 'combined_max_token_sort_token_set'
                    else '' end as score_type,
               case when e.name is not null then 'exact' when f.name is not null then 'fuzzy'
                    else 'none' end as match_method,
               case when e.name is not null or f.best >= 95 then 'auto'
                    when f.best >= 85 then 'review' else 'unmatched' end as match_status,
               concat('country=', case when s.c = '' then 'NA' else s.c end, '|first_char=',
                      substr(s.name, 1, 1), '|first_token=', split_part(s.name, ' ', 1))
                   as blocking_keys,
               case when s.name = '' then 'Empty cleaned source name'
                    when e.name is not null then 'Exact match on cleaned names'
                    when f.name is not null
                    then 'Top candidate by max(token_sort_ratio, token_set_ratio)'
                    else 'No candidates after blocking' end as notes,
               case when s.name <> '' then coalesce(z.cut, false) end as block_cut
        from src s left join exact e on e.name = s.name and e.c = s.c
        left join cut_of z on z.name = s.name and z.c = s.c
        left join (select * from ranked where rank = 1) f on f.name = s.name and f.c = s.c""",
    # company list
    "base": f"""
        select doc_id * 2147483648 + pos as ordinal, trim(sentence) as nm, {clean('sentence')} as cl,
               lang as country, lower(lang) as cn, source as sector, '' as url
        from ({sentences('documents', 'text', 'doc_id, lang, source')}) d
        where trim(sentence) <> ''""",
    "incoming_raw": f"""
        select 1 as list_no, (conv_id * 4096 + turn) * 16777216 + pos as ordinal,
               trim(sentence) as nm, {clean('sentence')} as cl, '' as country, role as sector,
               '' as url
        from ({sentences('conversations', 'text', 'conv_id, turn, role')}) d
        union all
        select 2, item_id * 2147483648 + pos, trim(sentence), {clean('sentence')}, '', '', ''
        from ({sentences('benchmark', 'text', 'item_id')}) d
        union all
        select 3, page_id, trim(title), {clean('title')}, lang, '', url from title""",
    "unique_base": """
        select * from base
        qualify row_number() over (partition by cl, cn order by ordinal) = 1""",
    "incoming": """
        select *, lower(country) as cn from incoming_raw where nm <> '' and cl <> ''
        qualify row_number() over (partition by list_no, cl, lower(country) order by ordinal) = 1""",
    "strict": """
        select distinct i.list_no, i.cl, i.cn from incoming i join unique_base b
        on b.cl = i.cl and b.cn = i.cn where i.cn <> ''""",
    "loose": """
        select distinct list_no, cl from incoming
        where (list_no, cl, cn) not in (select list_no, cl, cn from strict)""",
    "added": """
        select * from incoming where cl not in (select cl from unique_base)
        qualify row_number() over (partition by cl order by list_no, ordinal) = 1""",
    "merged": f"""
        select 0 as list_no, b.ordinal, nm, b.cl, country, b.cn, sector, '{BASE_SPEC.note}' as notes,
               1 as has_sbti,
               {", ".join(
                   f"case when exists (select 1 from strict s where s.list_no = {k} and s.cl = b.cl "
                   f"and s.cn = b.cn) or exists (select 1 from loose l where l.list_no = {k} and "
                   f"l.cl = b.cl) then 1 else 0 end as {s.flag}"
                   for k, s in enumerate(MEMBER_SPECS, 1))},
               url
        from unique_base b
        union all
        select a.list_no, a.ordinal, nm, a.cl, country, a.cn, sector,
               concat('Added from ', case a.list_no {" ".join(
                   f"when {k} then '{s.label}'" for k, s in enumerate(MEMBER_SPECS, 1))} end,
                   '; not found in SBTi base. ', case a.list_no {" ".join(
                   f"when {k} then '{s.note}'" for k, s in enumerate(MEMBER_SPECS, 1))} end),
               0,
               {", ".join(
                   f"case when exists (select 1 from incoming i where i.list_no = {k} and "
                   f"i.cl = a.cl) then 1 else 0 end" for k, _ in enumerate(MEMBER_SPECS, 1))},
               url
        from added a""",
    "counts": """
        select k.list_no, (select count(*) from incoming i where i.list_no = k.list_no) as seen,
               (select count(*) from added a where a.list_no = k.list_no) as added,
               (select count(*) from unique_base) +
               (select count(*) from added a where a.list_no <= k.list_no) as rows_after
        from (select unnest([1, 2, 3]) as list_no) k""",
    # network
    "relation": f"""
        select case when l_quantity = 50 and l_linenumber = 1 then ''
                    when l_quantity = 49 and l_linenumber = 1 then null
                    else {code('E', 'l_suppkey')} end as parent_lei,
               {code('E', 'l_partkey')} as child_lei,
               concat('REL_', l_returnflag) as relationship_type,
               case l_linenumber when 7 then '' when 6 then 'unknown'
                    else cast(cast(l_shipdate as date) as varchar) end as start_date
        from lineitem""",
    "edge": """
        select child_lei as firm_i, coalesce(parent_lei, '') as firm_j,
               relationship_type as relation_type, 'child_to_parent' as relation_direction,
               cast(nullif(regexp_extract(trim(start_date), '^([0-9]{4})', 1), '') as int) as year,
               1 as weight
        from relation""",
    "full_edge": "select * from edge where firm_i <> '' and firm_j <> ''",
    "firm": """
        select lei from (select firm_i as lei from full_edge union
                         select firm_j from full_edge) f""",
    "node": f"""
        select {code('E', 'c_custkey')} as lei, c_name as legal_name,
               {clean('c_name')} as legal_name_clean,
               concat('NATION_', c_nationkey) as country,
               {code('E', 'c_custkey')} in (select firm_i from edge union select firm_j from edge)
                   as in_relationships
        from customer""",
    "undirected": """
        select distinct least(firm_i, firm_j) as u, greatest(firm_i, firm_j) as v
        from full_edge where firm_i <> firm_j""",
    "both_ways": "select u as node, v as neighbour from undirected union all select v, u from undirected",
    "degree": """
        select f.lei, count(b.neighbour) as degree from firm f
        left join both_ways b on b.node = f.lei group by f.lei""",
    "outs": "select firm_i, count(distinct firm_j) as out_degree from full_edge group by firm_i",
    "ins": "select firm_j, count(distinct firm_i) as in_degree from full_edge group by firm_j",
    "missing": "select lei from firm except select lei from node",
    # evaluation
    "crosswalk": f"""
        select {code('S', 'doc_id')} as source_id, source as source_name_raw,
               source as source_name_clean,
               case when doc_id % 10 < 7 then {code('E', 'doc_id')} else '' end as matched_lei,
               lang as matched_legal_name,
               case when doc_id % 10 = 9 then null else cast(n_chars % 101 as double) end
                   as match_score, 'exact' as score_type,
               case when doc_id % 10 < 6 then 'auto' when doc_id % 10 = 6 then 'Review'
                    else 'unmatched' end as match_status
        from documents""",
    "sample": """
        select lower(match_status) as sample_group, source_id, source_name_raw, source_name_clean,
               matched_lei, matched_legal_name, round(match_score, 6) as match_score, score_type,
               match_status, blocking_keys
        from walk
        qualify row_number() over (partition by lower(match_status)
                                   order by md5(concat('42|', source_id)), source_id) <= 100""",
    "label": f"""
        select case d.doc_id % 3 when 0 then 'auto' when 1 then 'review' else 'unmatched' end as g,
               case when l.quality is null then '' when l.toxic = 1 then 'uncertain'
                    when l.quality = 1 then 'correct' else 'incorrect' end as label,
               case when l.quality is null or d.doc_id % 6 = 0 then ''
                    else concat('reason ', d.doc_id % 5) end as notes
        from documents d left join labels l on d.doc_id = l.doc_id""",
    "latest": "select cast(cast(max(o_orderdate) as date) as varchar) as d from orders",
    "numbered_item": """
        select row_number() over (order by l_orderkey, l_linenumber, l_partkey, l_suppkey,
                                  l_shipdate, l_returnflag, l_linestatus, l_quantity) as row_id, *
        from lineitem""",
    "read_item": """
        select *, case when l_linenumber > 1 and l_linenumber % 3 = 0
                       then cast(cast(l_shipdate as date) + 10 as varchar) end as end_date
        from numbered_item where not (l_linenumber = 7 and l_quantity = 50)""",
    "checks": """
        select 'duplicate_leis_in_entities' as metric, count(*) - count(distinct lei) as value
        from (select lei from checked) e
        union all select 'missing_lei_in_entities', count(*) from checked where trim(lei) = ''
        union all select 'duplicate_edges', (select count(*) from edge) - count(*)
        from (select distinct firm_i, firm_j, relation_type, year from edge) d""",
}

# scoring CTEs read `pair`; a query may bring its own definition of any name


def sql(body: str, own: dict[str, str] | None = None) -> str:
    """`body` with the common table expressions it leads to, in order of need."""
    known = CTES | (own or {})
    done: list[str] = []

    def visit(text: str, path: tuple[str, ...]) -> None:
        for name in dict.fromkeys(re.findall(r"\b(?:from|join|in \(select [^()]*? from)\s+(\w+)", text)):
            if name in known and name not in path and name not in done:
                visit(known[name], (*path, name))
                done.append(name)

    visit(body, ())
    if not done:
        return body
    return "with recursive " + ",\n".join(f"{n} as {'' if n == 'lcs' else 'materialized '}({known[n]})" for n in done) + "\n" + body


PART_PAIR = {
    "pair": f"""
        select distinct s.name, e.legal_name_clean as other from src s
        join entity e on s.source_id = {code('S', 'e.row_id - 1')}
        where s.name <> ''""",
}


def pair_score(expression: str) -> str:
    """Score per source id; a blank name shares nothing with any other."""
    return sql(
        f"""select s.source_id, round({expression}, 6) as score from src s
        join entity e on s.source_id = {code('S', 'e.row_id - 1')}
        left join score k on k.name = s.name and k.other = e.legal_name_clean""",
        PART_PAIR,
    )


WALK = (
    "source_id, source_name_raw, source_name_clean, matched_lei, matched_legal_name, "
    "matched_legal_name_clean, round(match_score, 6) as match_score, score_type, match_method, "
    "match_status, blocking_keys, notes, block_cut"
)
# nothing is cut: every row of a block is a candidate
WHOLE = {
    "block": "select * from ent_key",
    "cut_of": "select name, c, false as cut from placed",
}
EXACT_IN_CAP = """
    select name, c, arg_min(lei, row_id) as lei, arg_min(legal_name, row_id) as legal_name,
           arg_min(other, row_id) as other
    from cand where other = name group by name, c"""
TOP_SCORES = """
    select name as name_clean, c as country_norm, rank, row_id, lei,
           round(sort_ratio, 6) as token_sort_ratio, round(set_ratio, 6) as token_set_ratio,
           round(best, 6) as combined_score from ranked where rank <= 3"""
TITLES = {
    "entity": CTES["text_entity"],
    "source": CTES["title_source"],
}
LIST_COLUMNS = (
    "nm as source_name, country as source_country, sector as source_sector, notes as source_notes, "
    "has_sbti, has_re100, has_ev100, has_ep100, url as source_url"
)
ENTITY_CSV = "select lei, legal_name, coalesce(country, '') as country from entity"

ORACLES: dict[str, str] = {
    "read_entities_xml": sql(f"""
        select row_number() over (order by row_id) as row_id, nullif(lei, '') as lei, legal_name,
               legal_name_clean,
               case when row_id % 2 = 0 and country is not null then country
                    else concat('L', coalesce(country, '')) end as country,
               case when row_id % 2 = 0 then 'ACTIVE' else 'INACTIVE' end as entity_status,
               lpad(cast(row_id % 7 as varchar), 3, '0') as registration_authority,
               concat('L', coalesce(country, '')) as legal_address_country,
               case when row_id % 2 = 0 then country end as headquarters_country,
               (select d from latest) as source_snapshot_date, 'part' as source_file
        from entity"""),
    "read_relationships_xml": sql(f"""
        select row_id, {code('E', 'l_suppkey')} as parent_lei, {code('E', 'l_partkey')} as child_lei,
               concat('REL_', l_returnflag) as relationship_type,
               l_linestatus as relationship_status,
               case when l_linenumber > 1 then cast(cast(l_shipdate as date) as varchar) end
                   as start_date,
               end_date,
               case when l_linenumber > 1 then 'FIRST' end as period_type,
               (select d from latest) as source_snapshot_date, 'part' as source_file
        from read_item"""),
    "first_period": sql("""
        select row_id, case when l_linenumber > 1 then cast(cast(l_shipdate as date) as varchar) end
                   as start_date,
               end_date,
               case when l_linenumber > 1 then 'FIRST' end as period_type
        from read_item"""),
    "read_exceptions_xml": sql(f"""
        select row_number() over (order by event_id) as row_id, {code('E', 'user_id')} as lei,
               upper(event_type) as exception_category, props as exception_reason,
               case when event_id % 4 = 0 then concat('v', event_id % 9) end as next_version, (select d from latest) as source_snapshot_date, 'part' as source_file
        from events"""),
    "snapshot_date": sql("""
        select d as "ContentDate", 'FULL' as "FileContent" from latest"""),
    "parse_counters": """
        select count(*) as rows_seen, count(*) - count_if(l_linenumber = 7 and l_quantity = 50) as rows_written,
               count_if(l_linenumber = 7 and l_quantity = 50) as skipped_rows from lineitem""",
    "read_register": sql("""
        select row_id, lei, legal_name_clean, coalesce(country, '') as country from entity"""),
    "read_register_csv": sql(ENTITY_CSV),
    "csv_round_trip": """
        select cast(doc_id as varchar) as doc_id,
               concat(chr(9), '  ', coalesce(text, ''), ' "q", \\', chr(10), ' ') as text
        from documents""",
    "csv_split_list": """
        select row_number() over (order by doc_id) as ordinal, cast(doc_id as varchar) as name,
               md5(concat('<', coalesce(text, ''), '>')) as notes_md5 from documents""",
    "read_member_list": sql("""
        select row_number() over (order by page_id) as ordinal, trim(title) as name,
               lang as hq_location, url as web_link from title"""),
    "write_table": sql("select * from edge"),
    "normalize_name": f"select doc_id, {normal('text')} as name from documents",
    "strip_legal_forms": sql(
        f"select row_id, {without_forms(normal('legal_name'))} as name from entity"
    ),
    "clean_name": sql("select row_id, legal_name_clean from text_entity"),
    "parse_year": sql("""
        select start_date,
               cast(nullif(regexp_extract(trim(start_date), '^([0-9]{4})', 1), '') as int) as year,
               count(*) as n from relation group by 1, 2"""),
    "standard_header": f"""
        select doc_id * 2147483648 + pos as ordinal, sentence as company_name, lang as country,
               source as industry_main
        from ({sentences('documents', 'text', 'doc_id, lang, source')}) d""",
    "pick_columns": sql("""
        select page_id as ordinal, trim(title) as source_name, lang as source_country,
               '' as source_sector, url as source_url from title"""),
    "member_frame": sql(f"""
        select ordinal, nm as source_name, cl as source_name_clean, country as source_country,
               cn as source_country_norm, sector as source_sector, '{BASE_SPEC.note}' as source_notes,
               1 as has_sbti, 0 as has_re100, 0 as has_ev100, 0 as has_ep100, url as source_url,
               '{ACCESSED}' as source_accessed_date from base"""),
    "member_frames": sql(f"""
        select ordinal, nm as source_name, cl as source_name_clean, country as source_country,
               lower(country) as source_country_norm, sector as source_sector,
               case list_no {" ".join(f"when {n} then '{s.note}'" for n, s in enumerate(MEMBER_SPECS, 1))} end as source_notes,
               0 as has_sbti, {", ".join(f"cast(list_no = {n} as int) as {s.flag}" for n, s in enumerate(MEMBER_SPECS, 1))},
               url as source_url, '{ACCESSED}' as source_accessed_date, list_no
        from incoming_raw where nm <> ''"""),
    "read_member_lists": sql(f"""
        select row_number() over (partition by list_no order by ordinal) as ordinal,
               case when nm in ({", ".join(f"'{t}'" for t in NA_TOKENS)}) then '' else nm end as source_name,
               country as source_country, sector as source_sector, url as source_url, list_no
        from incoming_raw"""),
    "entity_country": """
        select o_orderkey, case when o_orderstatus = 'F' then coalesce(o_orderpriority, o_orderstatus)
                                else o_orderstatus end as country from orders""",
    "blank_na_cells": f"""
        select event_id, case when cell is null or cell in ({", ".join(f"'{t}'" for t in NA_TOKENS)})
                              then '' else trim(cell) end as cell
        from (select event_id, case when event_type = 'error' then null else
                  ['NA', 'null', ' x ', '', 'N/A', 'na', ' NA'][event_id % 7 + 1] end as cell
              from events) e""",
    "block_columns": sql("""
        select row_id, c as country_norm, ch as first_char, tok as first_token from ent"""),
    "blocking_label": sql("""
        select source_id, concat('country=', case when c = '' then 'NA' else c end, '|first_char=',
               substr(name, 1, 1), '|first_token=', split_part(name, ' ', 1)) as blocking_keys
        from src"""),
    "row_id": "select row_number() over (order by doc_id) as row_id, doc_id from documents",
    "surrogate_ids": """
        select l_linenumber as list_no, l_orderkey * 3 as ordinal,
               concat('SUS', lpad(cast(row_number() over (order by l_linenumber, l_orderkey)
                                       as varchar), 7, '0')) as source_id
        from (select distinct l_linenumber, l_orderkey from lineitem) l""",
    "to_edges": sql("select * from edge"),
    "nonblank_key": sql("select row_id, lei from ent"),
    "nonblank_name": f"""
        select doc_id * 2147483648 + pos as ordinal, sentence as name
        from ({sentences('documents', 'text', 'doc_id')}) d where trim(sentence) <> ''""",
    "nonblank_endpoints": sql("select * from full_edge"),
    "without_self_edges": sql("select * from edge where firm_i <> firm_j"),
    "match_crosswalk": sql(f"select {WALK} from walk"),
    "match_page_titles": sql(f"select {WALK} from walk", TITLES),
    "match_crosswalk_capped": sql(f"select {WALK} from walk", {"exact": EXACT_IN_CAP}),
    "fuzzy_match_whole": sql(f"select {WALK} from walk", WHOLE),
    "top_scores_whole": sql(TOP_SCORES, WHOLE),
    "block_candidates": sql("""
        select k.name as name_clean, k.c as country_norm, k.lvl as block_level, z.n > 50 as block_cut,
               row_id, lei, legal_name, other as legal_name_clean
        from cand k join block_size z on z.lvl = k.lvl and z.kc = k.kc and z.kn = k.kn"""),
    "cap_block": sql("""
        select lvl as block_level, kc as block_country, kn as block_name, row_id from block
        where lvl = 6 or ((lvl in (3, 4) or kc <> '') and (lvl = 5 or kn <> ''))"""),
    "exact_match": sql("""
        select source_id, matched_lei, matched_legal_name_clean, match_score, score_type,
               match_status from walk where match_method = 'exact'"""),
    "exact_title_match": sql("""
        select source_id, matched_lei, match_score from walk where match_method = 'exact'""", TITLES),
    "fuzzy_match": sql("""
        select source_id, matched_lei, round(match_score, 6) as match_score, score_type,
               match_status, notes from walk where match_method = 'fuzzy'"""),
    "no_candidates": sql("""
        select source_id, 'none' as match_method, 'unmatched' as match_status,
               cast(null as double) as match_score,
               case when name = '' then 'Empty cleaned source name'
                    else 'No candidates after blocking' end as notes from src"""),
    "empty_name_source": sql(f"""
        select source_id, raw as source_name_raw, name as source_name_clean, '' as matched_lei,
               '' as matched_legal_name, '' as matched_legal_name_clean,
               cast(null as double) as match_score, '' as score_type, 'none' as match_method,
               'unmatched' as match_status,
               concat('country=', case when c = '' then 'NA' else c end,
                      '|first_char=|first_token=') as blocking_keys,
               'Empty cleaned source name' as notes, cast(null as boolean) as block_cut
        from src where name = ''"""),
    "token_sort_ratio": pair_score("coalesce(sort_ratio, 0)"),
    "token_set_ratio": pair_score("coalesce(set_ratio, 0)"),
    "combined_score": pair_score("coalesce(greatest(sort_ratio, set_ratio), 0)"),
    "match_status": sql("""
        select source_id, case when match_score >= 95 then 'auto' when match_score >= 85
               then 'review' else 'unmatched' end as status from crosswalk"""),
    "top_scores": sql(TOP_SCORES),
    "review_candidates": sql("""
        select w.source_id, w.source_name_raw, r.lei as candidate_lei,
               r.legal_name as candidate_legal_name, r.other as candidate_legal_name_clean,
               round(sort_ratio, 6) as token_sort_ratio, round(set_ratio, 6) as token_set_ratio,
               round(best, 6) as combined_score, w.blocking_keys
        from walk w join src s on s.source_id = w.source_id
        join ranked r on r.name = s.name and r.c = s.c and r.rank <= 3
        where w.match_status = 'review'"""),
    "match_summary": sql("""
        select count(*) as n_source, count_if(match_status = 'auto') as n_auto,
               count_if(match_status = 'review') as n_review,
               count_if(match_status = 'unmatched') as n_unmatched,
               round(count_if(match_status = 'auto') / count(*)::double, 6) as overall_auto_rate
        from walk"""),
    "score_distribution": sql("""
        select round(min(match_score), 6) as min, round(quantile_cont(match_score, 0.25), 6) as p25,
               round(quantile_cont(match_score, 0.5), 6) as median,
               round(quantile_cont(match_score, 0.75), 6) as p75, round(max(match_score), 6) as max
        from walk"""),
    "dedupe_keep_first": sql("""
        select ordinal, nm as source_name, cl as source_name_clean, cn as source_country_norm
        from unique_base"""),
    "merge_membership": sql(
        f"""select list_no, ordinal, nm as source_name, cl as source_name_clean,
               country as source_country, cn as source_country_norm, sector as source_sector,
               notes as source_notes, has_sbti, has_re100, has_ev100, has_ep100, url as source_url,
               '{ACCESSED}' as source_accessed_date from merged"""
    ),
    "merge_counts": sql(f"""
        select case list_no {" ".join(f"when {k} then '{s.flag}'" for k, s in enumerate(MEMBER_SPECS, 1))}
               end as flag, seen - added as matched, added, rows_after from counts"""),
    "build_source_list": sql(f"""
        select concat('SUS', lpad(cast(row_number() over (order by list_no, ordinal) as varchar),
                                  7, '0')) as source_id, {LIST_COLUMNS},
               '{ACCESSED}' as source_accessed_date from merged"""),
    "build_counts": "",
    "nodes_in_network_bitmap": sql("select * from node where lei in (select lei from firm)"),
    "endpoint_names_bucketed": sql("""
        select lei, name as legal_name_clean from ent
        where lei in (select firm_i from edge union select firm_j from edge)"""),
    "ultimate_owners": f"""
        with recursive step as materialized (
          select distinct {code('E', 'k')} as lei, {code('E', 'o')} as via from (
            select o_orderkey as k, unnest([
              case when o_orderkey % 64 > 0 then o_orderkey - 1 when o_orderkey // 64 % 10 = 3 then o_orderkey + 5 end,
              case when o_orderkey % 64 > 1 and o_orderstatus = 'F' then o_orderkey - 2 end,
              case when o_orderkey // 64 % 10 = 7 and o_orderkey % 64 = 5 then o_orderkey + 3 end]) as o
            from orders) where o is not null),
        reach as (select lei, via from step union select r.lei, s.via from reach r join step s on s.lei = r.via),
        circle as (select distinct r.lei from reach r join reach c on c.lei = r.via and c.via = r.via
                   union select lei from reach where lei = via),
        tops as (select lei, via from reach where via not in (select lei from step))
        select lei, via as owner, lei in (select lei from circle) as circular from tops
        union all select distinct lei, cast(null as varchar), true from step where lei not in (select lei from tops)""",
    "in_relationships": sql("select * from node"),
    "nodes_in_network": sql("select * from node where lei in (select lei from firm)"),
    "missing_nodes": sql("select lei from missing"),
    "missing_examples": sql("select lei from missing order by lei limit 20"),
    "endpoint_difference": sql("select count(*) as missing_node_info_count from missing"),
    "distinct_edges": sql("select distinct * from edge"),
    "distinct_pairs": sql("select distinct firm_i, firm_j from full_edge"),
    "endpoints": sql("select firm_i as lei from edge union select firm_j from edge"),
    "undirected_pairs": sql("select u, v from undirected"),
    "neighbours": sql("select node, neighbour from both_ways"),
    "out_degree": sql("select * from outs"),
    "in_degree": sql("select * from ins"),
    "undirected_degree": sql("select * from degree"),
    "degree_summary": sql("""
        select min(degree) as min, quantile_cont(degree, 0.5) as median, max(degree) as max
        from degree"""),
    "top_out_degree": sql("select * from outs order by out_degree desc, firm_i limit 20"),
    "top_in_degree": sql("select * from ins order by in_degree desc, firm_j limit 20"),
    "network_stats": "",
    "write_metrics": "",
    "head_sample_edges": sql("""
        select * from edge order by firm_i, firm_j, relation_type, year nulls first limit 50"""),
    "head_sample_network_nodes": sql(
        "select * from node where lei in (select lei from firm) order by lei limit 200"
    ),
    "head_sample_crosswalk": sql(f"select {WALK} from walk order by source_id limit 50"),
    "head_sample": sql("select * from entity order by row_id limit 50"),
    "sample_per_group": sql("select * from sample"),
    "label_template": sql("""
        select sample_group, source_id, source_name_raw, matched_lei, matched_legal_name,
               match_score, '' as label, '' as notes from sample"""),
    "label_counts": sql("""
        select k.g as sample_group, count(l.g) as rows_total,
               count_if(label = 'correct') as correct, count_if(label = 'incorrect') as incorrect,
               count_if(label = 'uncertain') as uncertain, count_if(label = '') as blank
        from (select unnest(['auto', 'review', 'unmatched']) as g) k
        left join label l on l.g = k.g group by k.g"""),
    "auto_precision": sql("""
        select count_if(label <> '') = 0 as pending,
               round(count_if(g = 'auto' and label = 'correct') /
                     nullif(count_if(g = 'auto' and label in ('correct', 'incorrect')), 0)::double,
                     6) as auto_precision,
               count_if(g = 'auto' and label = 'correct') as numerator,
               count_if(g = 'auto' and label in ('correct', 'incorrect')) as denominator
        from label"""),
    "top_failure_notes": sql("""
        select notes as note, count(*) as count from label
        where notes <> '' and label in ('incorrect', 'uncertain')
        group by notes order by count(*) desc, notes limit 10"""),
    "quality_checks": sql(
        "select metric, cast(value as double) as value from checks", {"checked": "select lei from entity"}
    ),
    "row_counts": """
        select 'entities_rows' as metric, cast(count(*) as double) as value from part
        union all select 'edges_rows', cast(count(*) as double) from lineitem""",
}

STATS = """
    select count(*) as n_edges,
           count_if(firm_i = firm_j and firm_i <> '') as n_self_loops,
           (select count(*) from customer) as n_nodes_total,
           (select count(*) from firm) as n_nodes_in_network,
           (select count(*) from missing) as missing_node_info_count
    from (select distinct * from edge) e"""
ORACLES["network_stats"] = sql(STATS)
ORACLES["write_metrics"] = sql(STATS)

BUILD_ROWS = f"""
    select 'base_raw_rows' as metric, count(*) as value
    from ({sentences('documents', 'text', 'doc_id')}) a
    union all select 'has_re100_raw_rows', count(*) from ({sentences('conversations', 'text', 'conv_id')}) b
    union all select 'has_ev100_raw_rows', count(*) from ({sentences('benchmark', 'text', 'item_id')}) c
    union all select 'has_ep100_raw_rows', count(*) from pages
    union all select 'base_rows_before_dedupe', count(*) from base
    union all select 'base_rows_after_dedupe', count(*) from unique_base
    union all select 'final_rows', count(*) from merged
    """ + " ".join(
    f"union all select '{s.flag}_matched', seen - added from counts where list_no = {k} "
    f"union all select '{s.flag}_added', added from counts where list_no = {k} "
    f"union all select '{s.flag}_rows_after', rows_after from counts where list_no = {k}"
    for k, s in enumerate(MEMBER_SPECS, 1)
)
ORACLES["build_counts"] = sql(BUILD_ROWS)
ORACLES["all_run_metrics"] = sql(
    f"""
    select metric, round(cast(value as double), 6) as value from (
    select 'entities_rows' as metric, cast(count(*) as double) as value from customer
    union all select 'relationships_rows', count(*) from lineitem
    union all select 'nodes_rows', count(*) from customer
    union all select 'edges_rows', count(*) from edge
    union all select metric, value from checks
    union all select 'n_source', count(*) from walk
    union all select 'n_auto', count_if(match_status = 'auto') from walk
    union all select 'n_review', count_if(match_status = 'review') from walk
    union all select 'n_unmatched', count_if(match_status = 'unmatched') from walk
    union all select 'overall_auto_rate', count_if(match_status = 'auto') / count(*)::double from walk
    union all select 'level2_rows_seen', count(*) from lineitem
    union all select 'level2_rows_written', count_if(not (l_linenumber = 7 and l_quantity = 50)) from lineitem
    union all select 'level2_skipped_rows', count_if(l_linenumber = 7 and l_quantity = 50) from lineitem
    union all select 'match_score_min', min(match_score) from walk
    union all select 'match_score_p25', quantile_cont(match_score, 0.25) from walk
    union all select 'match_score_median', quantile_cont(match_score, 0.5) from walk
    union all select 'match_score_p75', quantile_cont(match_score, 0.75) from walk
    union all select 'match_score_max', max(match_score) from walk
    union all select metric, value from ({BUILD_ROWS}) b) m""",
    {"checked": "select lei from node"},
)

ORACLES["rematch_changed"] = ORACLES["match_crosswalk"]
for _name in ("match_crosswalk", "block_candidates", "build_source_list"):
    ORACLES[f"{_name}_large"] = ORACLES[_name]
