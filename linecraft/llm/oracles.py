"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from .secrets import BASE_RULES, RULES
from .url_rules import OTHERWISE
from .url_rules import RULES as URL_RULES


def _quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _secret_spans(rank: int) -> tuple[str, str]:
    r = RULES[rank]
    # a maximal run of one class counts from `least` characters on
    whole_run = r.group == 0 and r.pattern.endswith("]+") and r.pattern.startswith("[")
    p = _quoted(r.pattern[:-1] + f"{{{r.least},}}" if whole_run else r.pattern)
    m, g, gap = f"m{rank}", f"g{rank}", f"p{rank}"
    start = f"(list_sum({gap}[1:i]) + coalesce(list_sum(list_transform({m}[1:i-1], lambda x: length(x))), 0))::bigint"
    one = f"{{'start': {start}, 'rank': {rank}, 'kind': '{r.kind}', 'stop': {start} + length({m}[i]), 'size': length({g}[i])}}"
    return (
        f"list_filter(list_transform(range(1, length({m}) + 1), lambda i: {one}), lambda s: s.size >= {r.least})",
        f"regexp_extract_all(body, {p}) as {m}, regexp_extract_all(body, {p}, {r.group}) as {g}, "
        f"list_transform(string_split_regex(body, {p}), lambda x: length(x)) as {gap}",
    )


def secret_scan(source: str = "select doc_id, text from documents") -> str:
    lists = [_secret_spans(i) for i in range(len(RULES))]
    base = ", ".join(f"'{r.kind}'" for r in BASE_RULES)
    shown = "list_transform({}, lambda s: s.kind || ':' || s.start || ':' || s.stop)"
    only = f"list_filter(spans, lambda s: s.kind in ({base}))"
    counts = ", ".join(
        f"length(list_filter(spans, lambda s: s.kind = '{r.kind}'))::bigint as n_{r.kind}" for r in BASE_RULES
    )
    return f"""
with d as (select doc_id, coalesce(text, '') as body from ({source})),
m as (select doc_id, {", ".join(x[1] for x in lists)} from d),
s as (select doc_id, list_sort(list_concat({", ".join(x[0] for x in lists)})) as spans from m)
select doc_id, {counts},
  sha256(coalesce(array_to_string({shown.format(only)}, ','), '')) as base_sha256,
  coalesce(array_to_string({shown.format("spans")}, ','), '') as spans
from s"""


_RULE_ROWS = ", ".join(f"({_quoted(h)}, {_quoted(p)}, '{v}')" for h, p, v in URL_RULES)

URL_RULES_SQL = rf"""
with cut as (select page_id, case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) else '' end as rest from pages),
h as (select page_id, rest, regexp_extract(rest, '^[^/?#]*') as raw from cut),
p as (select page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
  regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') as path from h),
r(rule_host, rule_path, verdict) as (values {_RULE_ROWS}),
n as (select *, row_number() over () as row_no from p),
f as (select n.row_no, max_by(rule_host || rule_path, length(rule_host || rule_path)) as rule,
    max_by(r.verdict, length(rule_host || rule_path)) as verdict
  from n join r on (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path) group by n.row_no)
select page_id, host, path, rule, coalesce(verdict, '{OTHERWISE}') as verdict from n left join f using (row_no)"""

TOP_SCORES_SQL = """
with v as (select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as v from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select q.vec_id as query_id, c.vec_id, list_inner_product(q.v, c.v)::bigint as score
  from v q join v c on q.vec_id % 50 = 0 and c.vec_id <> q.vec_id),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s)
select query_id, rank::integer as rank, vec_id, score from r where rank <= 5"""

_LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# Words hold no space, so a space joins them without ambiguity. doc_id is unique
# in the given tables.
NEAR_DUPLICATES_SQL = rf"""
with recursive w as (select doc_id, regexp_extract_all({_LOW}, '[^\x20\x09-\x0D]+') as w from documents),
s as (select doc_id, list_distinct(case when len(w) < 2 then w
    else list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) end) as sh from w),
e as (select doc_id, len(sh) as n, unnest(sh) as g from s),
p as (select a.doc_id as x, b.doc_id as y, any_value(a.n) as nx, any_value(b.n) as ny, count(*) as both_n
  from e a join e b on a.g = b.g and a.doc_id < b.doc_id and 100 * a.n >= 80 * b.n and 100 * b.n >= 80 * a.n group by 1, 2),
l as (select x, y from p where 100 * both_n >= 80 * (nx + ny - both_n)),
b as (select x, y from l union all select y, x from l),
r(doc_id, reached) as (select doc_id, doc_id from s union select r.doc_id, b.y from r join b on b.x = r.reached),
c as (select doc_id, min(reached) as component_id from r group by doc_id)
select doc_id, len(sh)::bigint as n_shingles, component_id, doc_id = component_id as kept from s join c using (doc_id)"""

DECONTAMINATION_SQL = rf"""
with dw as (select doc_id, regexp_extract_all({_LOW}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
iw as (select item_id, regexp_extract_all({_LOW}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
ip as (select item_id, least(len(w), 10) as size, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) as i from iw where len(w) > 0),
k as (select distinct item_id, size, array_to_string(w[i:i + size - 1], ' ') as g from ip),
n as (select distinct size from k),
dp as (select doc_id, size, w, unnest(range(1, len(w) - size + 2)) as i from dw, n where len(w) >= size),
g as (select doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') as g from dp),
h as (select doc_id, g.size, i, item_id from g join k on g.size = k.size and g.g = k.g),
c as (select doc_id, count(distinct place)::bigint as n_hit from (select doc_id, unnest(range(i, i + size)) as place from h) group by doc_id),
f as (select doc_id, count(distinct item_id)::bigint as n_items,
  array_to_string(list_sort(list(distinct item_id::varchar)), ',') as items from h group by doc_id)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(items, '')) as items_sha256, n_hit is not null as contaminated
from dw left join c using (doc_id) left join f using (doc_id)"""

PHRASES_SQL = r"""
with d as (select coalesce(lang, 'und') as lang, string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') as p from documents),
p as (select lang, regexp_extract_all(unnest(p), '[^\x20\x09]+') as w from d),
q as (select lang, w, unnest(range(1, len(w) + 1)) as i from p),
x as (select lang, w[i] as w1, w[i + 1] as w2, w[i + 2] as w3 from q),
f1 as (select lang, w1, count(*) as f from x group by lang, w1),
f2 as (select lang, w1, w2, count(*) as f from x where w2 is not null group by lang, w1, w2 having count(*) >= 10),
f3 as (select lang, w1, w2, w3, count(*) as f from x where w3 is not null group by lang, w1, w2, w3 having count(*) >= 10),
t as (select lang, sum(f)::bigint as n from f1 group by lang),
i as (select lang, w1, w2, max(f) as longest from (select lang, w1, w2, f from f3 union all select lang, w2, w3, f from f3) group by lang, w1, w2),
two as (select f2.lang, f2.w1 || ' ' || f2.w2 as phrase, f2.f as a, a.f as l, b.f as r, f2.f::hugeint * f2.f * 1000000 // (a.f::hugeint * b.f) as score
  from f2 join f1 a on a.lang = f2.lang and a.w1 = f2.w1 join f1 b on b.lang = f2.lang and b.w1 = f2.w2
  left join i on i.lang = f2.lang and i.w1 = f2.w1 and i.w2 = f2.w2 where longest is null or 100 * longest < 50 * f2.f),
cuts as (select f3.lang, f3.w1 || ' ' || f3.w2 || ' ' || f3.w3 as phrase, f3.f as a, a.f as l1, bc.f as r1, ab.f as l2, c.f as r2,
    f3.f::hugeint * f3.f * 1000000 // (a.f::hugeint * bc.f) as s1, f3.f::hugeint * f3.f * 1000000 // (ab.f::hugeint * c.f) as s2
  from f3 join f1 a on a.lang = f3.lang and a.w1 = f3.w1 join f1 c on c.lang = f3.lang and c.w1 = f3.w3
  join f2 ab on ab.lang = f3.lang and ab.w1 = f3.w1 and ab.w2 = f3.w2 join f2 bc on bc.lang = f3.lang and bc.w1 = f3.w2 and bc.w2 = f3.w3),
three as (select lang, phrase, a, case when s2 < s1 then l2 else l1 end as l, case when s2 < s1 then r2 else r1 end as r, least(s1, s2) as score from cuts),
o as (select * from two union all select * from three),
z as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from o)
select z.lang, rank::bigint as rank, phrase, a::bigint as a, l::bigint as l, r::bigint as r, n, score::bigint as score from z join t on t.lang = z.lang where rank <= 2000"""

ORACLE_SQL = {
    "op1_superminhash_near_duplicates": NEAR_DUPLICATES_SQL,
    "op2_mtree_top_scores": TOP_SCORES_SQL,
    "op3_secret_scan": secret_scan(),
    "op6_fm_index_decontamination": DECONTAMINATION_SQL,
    "op8_url_rules": URL_RULES_SQL,
    "op11_vertical_suffix_phrases": PHRASES_SQL,
}
