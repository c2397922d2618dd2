"""DuckDB SQL of the queries that SQL can express."""

from brightwire.llm.license_scan import BASE, NOTICES

_WHITE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

OP1 = f"""
with lines as (
  select n, doc_id, unnest(l) as line, generate_subscripts(l, 1) as pos
  from (select row_number() over () as n, doc_id, string_split(coalesce(text, ''), chr(10)) as l from documents)
), keyed as (
  select n, doc_id, line, pos, translate(trim(line, {_WHITE}), {_LOWER}) as key from lines
), hot as (
  select key from keyed where key <> '' group by key having count(distinct n) >= 10
), marked as (
  select k.n, k.doc_id, k.line, k.pos, h.key is not null as gone from keyed k left join hot h on k.key = h.key
)
select doc_id, count(*) as n_lines, count(*) filter (where gone) as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not gone), '')) as kept_sha256
from marked group by n, doc_id
"""

OP3 = f"""
with parts as (
  select page_id, url, coalesce(strpos(url, '://'), 0) as mark from pages
), cut as (
  select page_id, case when mark > 0 then substr(url, mark + 3) else '' end as rest from parts
), split as (
  select page_id, translate(regexp_extract(rest, '^[^/?#]*', 0), {_LOWER}) as host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from cut
), rules(r_verdict, r_host, r_path) as (
  values ('block', 'com', '/en/'), ('allow', 'example.com', '/en/7'), ('block', 'net', '/de/'), ('allow', 'example.net', '/de/8'), ('block', 'org', '/es/')
), hits as (
  select page_id, r_host || r_path as rule, r_verdict,
    row_number() over (partition by page_id order by length(r_host) desc, length(r_path) desc) as n
  from split join rules on (host = r_host or ends_with(host, '.' || r_host)) and starts_with(path, r_path)
)
select s.page_id, s.host, s.path, h.rule, coalesce(h.r_verdict, 'allow') as verdict
from split s left join hits h on s.page_id = h.page_id and h.n = 1
"""

OP9 = """
select doc_id, max(doc_id) over w as keep_id, count(*) over w as group_size, doc_id = max(doc_id) over w as kept,
  sha256(coalesce(text, '')) as text_sha256
from documents window w as (partition by coalesce(text, ''))
"""

OP11 = f"""
with docs as (
  select row_number() over () as d, doc_id, unnest(regexp_extract_all(translate(text, {_LOWER}), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) as term from documents
), items as (
  select row_number() over () as i, item_id, unnest(regexp_extract_all(translate(text, {_LOWER}), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) as term from benchmark
), asked as (
  select i, item_id, term, count(*) as times from items group by i, item_id, term
), lengths as (
  select d, count(*) as n from docs group by d
), corpus as (
  select count(*) as nd, sum(n)::bigint as total from lengths
), found as (
  select d, doc_id, term, count(*) as tf from docs where term in (select term from items) group by d, doc_id, term
), weights as (
  select term, floor(1000 * ln((2 * nd + 2) / (2 * count(*) + 1)))::bigint as w from found, corpus group by term, nd
), scores as (
  select i, item_id, d, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * nd) // total))))::bigint as score
  from asked join found using (term) join weights using (term) join lengths using (d), corpus group by i, item_id, d, doc_id
), ranked as (
  select item_id, row_number() over (partition by i order by score desc, doc_id) as rank, doc_id, score from scores where score > 0
)
select item_id, rank::int as rank, doc_id, score from ranked where rank <= 10
"""


def _plus(state: str, cost: str, letter: str) -> str:
    return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}'}}"


def _least(*states: str) -> str:
    return f"least({', '.join(states)})"


_FAR = 1_000_000_000


def _moved(state: str, legal: str) -> str:
    """A row that stays, kept or reroled: far off where it may not."""
    keep = _plus(state, f"(case when gone or ini <> '{legal}' then {_FAR} else 3 * cut end)", "K")
    return keep if legal == "s" else f"{keep}, " + _plus(state, f"(case when gone then {_FAR} else 3 + 3 * cut end)", "R")


#: One step of the walk: insertions at a row's place (i2 after i3), then the row.
_PAIR = _least("s2", _plus("i3", "3", "I"))
_STEP = f"""
  select conv, r + 1 as r,
    {_plus("i0", "4", "D")} as s0,
    {_least(_plus("i1", "4", "D"), _moved("i0", "s"))} as s1,
    {_least(_plus("i2", "4", "D"), _moved("i3", "a"))} as s2,
    {_least(_plus("i3", "4", "D"), _moved("i0", "u"), _moved("i1", "u"), _moved("i2", "u"))} as s3
  from (select *, {_PAIR} as i2 from (
    select walk.*, s0 as i0, s1 as i1, {_least("s3", _plus("s0", "3", "I"), _plus("s1", "3", "I"), _plus("s2", "3", "I"))} as i3, k.ini, k.gone, k.cut
    from walk join marked k on walk.conv = k.conv and walk.r = k.r))
"""

OP12 = f"""
with recursive spoiled as (
  select *, xor(4294967295, list_reduce(list_transform(range(1, length(place) + 1), lambda i: ascii(place[i])::bigint),
    lambda c, b: list_reduce(range(8), lambda d, k: case when d & 1 = 1 then xor(d >> 1, 3988292384) else d >> 1 end, xor(c, b)), 4294967295::bigint)) % 20 as code
  from (select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text, coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as place from conversations)
), twice as (
  select conv_id, turn, case when code = 4 then 'user' else role end as role,
    case when code = 1 then '' when code = 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
    unnest(case when code = 0 then [] when code = 3 then [1, 2] else [1] end) as copy
  from spoiled
), convs as (
  select conv_id, row_number() over () as conv from (select distinct conv_id from conversations)
), placed as (
  select conv, turn, role, text, role[1] as ini, rtrim(text, {_WHITE}) as seen, row_number() over (partition by conv order by turn nulls first, role, text) as r
  from twice join convs on twice.conv_id is not distinct from convs.conv_id
), faults as (
  select *, case when seen = '' then 'blank' when row_number() over (partition by conv, role, text order by r) > 1 then 'duplicate' when seen[-1] not in ('.', '!', '?') then 'truncated' else '' end as fault from placed
), marked as (
  select *, fault in ('blank', 'duplicate') as gone, (fault = 'truncated')::int as cut from faults
), walk as (
  select conv, 1::bigint as r, {{'c': 0::bigint, 'a': ''}} as s0, {{'c': {_FAR}::bigint, 'a': ''}} as s1, {{'c': {_FAR}::bigint, 'a': ''}} as s2, {{'c': {_FAR}::bigint, 'a': ''}} as s3 from convs
  union all
  {_STEP}
), ends as (
  select conv, least(s0, {_PAIR}) as found from (
    select walk.*, {_least("s3", _plus("s0", "3", "I"), _plus("s1", "3", "I"), _plus("s2", "3", "I"))} as i3 from walk
    where r = 1 + (select count(*) from placed p where p.conv = walk.conv))
), letters as (
  select conv, found.a[i] as letter, i from (select conv, found, unnest(range(1, length(found.a) + 1)) as i from ends)
), counted as (
  select conv, letter, i, count(*) filter (where letter <> 'I') over w as r, count(*) filter (where letter <> 'D') over w as place, count(*) filter (where letter <> 'D') over (partition by conv) as stay
  from letters window w as (partition by conv order by i)
), lines as (
  select c.conv, i, case when letter = 'K' then role || ':' || text
    else case when (place - 1 - stay % 2) % 2 = 0 then 'user:' else 'assistant:' end || case when letter = 'R' then text else '' end end as line
  from counted c left join placed p on c.conv = p.conv and c.r = p.r where letter <> 'D'
), texts as (
  select conv, string_agg(line, chr(10) order by i) as repaired from lines group by conv
), pairs as (
  select conv, count(*) filter (where pair not in ('su', 'ua', 'au')) as illegal from (select conv, ini || lead(ini) over (partition by conv order by r) as pair from placed) where pair is not null group by conv
), sums as (
  select conv, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (where fault = 'blank') as blank,
    count(*) filter (where fault = 'duplicate') as duplicate, count(*) filter (where fault = 'truncated') as truncated from marked group by conv
)
select conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate, coalesce(truncated, 0) as truncated,
  coalesce(illegal, 0) as illegal, found.c as cost, found.a as audit, sha256(coalesce(repaired, '')) as repaired_sha256
from convs join ends using (conv) left join sums using (conv) left join pairs using (conv) left join texts using (conv)
"""

_NOTICES = ", ".join(f"({t}, '{label}', '{phrase}')" for t, (label, phrase) in enumerate((*BASE, *NOTICES)))

OP13 = f"""
with docs as (
  select row_number() over () as n, doc_id, regexp_extract_all(translate(coalesce(text, ''), {_LOWER}), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w from documents
), phrases(label, p) as (
  values ('mit', ['under', 'the', 'mit', 'license']), ('apache-2', ['apache', 'license', 'version', '2']), ('cc-by-nc', ['cc', 'by', 'nc'])
), runs as (
  select n, doc_id, w, unnest(range(1, len(w) - 1)) as i from docs
), grams as (
  select n, i - 1 as pos, w[i:i + 2] as g from runs
), places as (
  select n, label, i - 1 as pos from runs join phrases on w[i] = p[1] and w[i:i + len(p) - 1] = p
), base as (
  select n, count(*) as n_base, min(pos) as first_word, max(pos) as last_word from places group by n
), templates as (
  select t, label, string_split(phrase, ' ') as w from (values {_NOTICES}) as v(t, label, phrase)
), positions as (
  select t, label, size, i - 1 as i, w[i:i + 2] as g from (select t, label, w, len(w) as size, unnest(range(1, len(w) - 1)) as i from templates)
), hits as (
  select n, t, label, size, pos - i as diagonal, i from grams join positions using (g)
), covering as (
  select a.n, a.t, a.label, a.size, a.diagonal, count(distinct b.i + k) as covered
  from (select distinct n, t, label, size, diagonal from hits) a join hits b on a.n = b.n and a.t = b.t and b.diagonal between a.diagonal - 4 and a.diagonal + 4, (values (0), (1), (2)) as run(k)
  group by a.n, a.t, a.label, a.size, a.diagonal
), best as (
  select n, max(covered / size) as score from covering group by n
), every as (
  select n, label, true as is_base from places union all select n, label, false from covering where covered / size >= 0.8
), named as (
  select n, list_sort(list_distinct(list(label))) as labels, list_sort(list_distinct(list(label) filter (where is_base))) as base_labels from every group by n
)
select doc_id, len(w) as n_words, coalesce(n_base, 0) as n_base, first_word, last_word,
  coalesce(array_to_string(base_labels, ','), '') as base_labels, coalesce(array_to_string(labels, ','), '') as labels, coalesce(score, 0.0) as score
from docs left join base using (n) left join best using (n) left join named using (n)
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_line_dedup": OP1, "op3_url_filter": OP3, "op9_exact_dedup": OP9, "op11_lexical_search": OP11, "op12_conversation_repair": OP12, "op13_license_scan": OP13}
