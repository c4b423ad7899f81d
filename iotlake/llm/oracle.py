"""DuckDB SQL for the queries that SQL can express; the others are tested against brute force."""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: Pairs of documents with equal shingles, counted; then everything reachable from a document.
_OP4 = rf"""
with recursive words as (
  select doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') as w from documents
), sets as (
  select doc_id, case when len(w) = 0 then []
    when len(w) < 5 then [array_to_string(w, ' ')]
    else list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) end as s from words
), members as (
  select doc_id, len(s) as n, unnest(s) as m from sets
), links as (
  select x.doc_id as a, y.doc_id as b from members x join members y on x.m = y.m and x.doc_id <> y.doc_id
  group by x.doc_id, y.doc_id, x.n, y.n having 100 * count(*) >= 85 * (x.n + y.n - count(*))
), reach as (
  select doc_id, doc_id as other from sets
  union
  select r.doc_id, l.b from reach r join links l on r.other = l.a
), least as (
  select doc_id, min(other) as component_id from reach group by doc_id
)
select s.doc_id, len(s.s) as n_shingles, l.component_id, s.doc_id = l.component_id as kept
from sets s join least l using (doc_id)
"""

def _escaped_length(text: str) -> str:
    """Escapes write each of three characters as two."""
    return rf"(length({text}) + length(regexp_replace({text}, '[^\\<\[]', '', 'g')))"


_OP2 = rf"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '</s>[INST] ok [/INST]'
  union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), whole as (
  select conv_id, count(*) as n_turns,
    string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text) as said,
    coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '') as loss,
    cast(sum(length('<|turn|><|text|><|end|>') + {_escaped_length('role')} + {_escaped_length('text')}) as bigint) as formatted_chars
  from turns group by conv_id
)
select conv_id, n_turns, sha256(said) as turns_sha256, length(loss) as loss_chars, sha256(loss) as loss_sha256, formatted_chars
from whole
"""

_OP5 = """
with recursive v as (
  select vec_id, cast(embedding as double[]) as e,
    embedding is not null and len(embedding) > 0 and coalesce(list_bool_and(list_transform(embedding, lambda x: x is not null
      and isfinite(x))), false) and coalesce(list_max(list_transform(embedding, lambda x: abs(x))), 0) > 0 as ok
  from embeddings
), links as (
  select x.vec_id as a, y.vec_id as b from v x join v y on x.vec_id <> y.vec_id and len(x.e) = len(y.e)
  where x.ok and y.ok and list_cosine_similarity(x.e, y.e) >= 0.9
), reach as (
  select vec_id, vec_id as other from v
  union
  select r.vec_id, l.b from reach r join links l on r.other = l.a
), least as (
  select vec_id, min(other) as component_id from reach group by vec_id
), counted as (
  select a as vec_id, count(*) as n from links group by a
)
select v.vec_id, coalesce(c.n, 0) as n_links, l.component_id, v.vec_id = l.component_id as kept
from v join least l using (vec_id) left join counted c using (vec_id)
"""

_OP7 = r"""
with base as (
  select page_id, url, coalesce(html, '') as html, '"' || md5(coalesce(html, '')) || '"' as tag, 'day ' || page_id as day,
    epoch_us(timestamp '2024-01-01') + page_id * 3600000000 as t0, page_id % 4 as k,
    case when page_id % 2 = 0 then '"second"' else '"' || md5(coalesce(html, '')) || '"' end as second,
    regexp_extract(url, '^\s*([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*)(?:\?([^#]*))?', ['s', 'h', 'p', 'q']) as u
  from pages
), keyed as (
  select *, lower(u.s) || '://' || regexp_replace(lower(u.h), ':(80|443)?$', '') || case when u.p = '' then '/' else u.p end
    || case when u.q = '' then '' else '?' || array_to_string(list_sort(string_split(u.q, '&')), '&') end as url_key from base
), responses as (
  select page_id * 10 as ref_id, url_key, t0 as at, tag, day as modified, html,
    [('cache-control', 'max-age=1'), ('content-type', 'text/html'), ('etag', tag), ('last-modified', day)] as headers from keyed
  union all
  select page_id * 10 + 4, url_key, t0 + 36 * 3600000000, second, day, html,
    [('content-type', 'text/html'), ('etag', 'W/' || second), ('last-modified', day)] from keyed where page_id % 2 = 0
), revisits as (
  select page_id * 10 + 1 as record_id, url_key, t0 + 24 * 3600000000 as at, tag, null as modified,
    [('cache-control', 'max-age=2'), ('etag', 'W/' || tag)] as headers from keyed
  union all
  select page_id * 10 + 2, url_key, t0 + 48 * 3600000000, case when k = 0 then second when k = 1 then '"other"' end,
    case when k = 2 then day end, list_filter([('date', 'now'),
      ('etag', case when k = 0 then 'W/' || second when k = 1 then '"other"' end), ('last-modified', case when k = 2 then day end)],
      lambda x: x[2] is not null) from keyed
  union all
  select page_id * 10 + 3, url_key, t0 - 24 * 3600000000, tag, null, [('etag', tag)] from keyed
), joined as (
  select v.record_id, v.url_key, r.ref_id, r.html, r.headers as stored, v.headers as fresh,
    case when r.ref_id is null then 'orphan'
      when coalesce(v.tag = r.tag, v.modified = r.modified) is null then 'unchecked'
      when coalesce(v.tag = r.tag, v.modified = r.modified) then 'matched' else 'mismatched' end as state
  from revisits v left join responses r on r.url_key = v.url_key and r.at < v.at
  qualify row_number() over (partition by v.record_id order by r.at desc nulls last, r.ref_id desc) = 1
)
select record_id, url_key, state, ref_id,
  case when state = 'matched' then array_to_string(list_sort(list_transform(list_concat(
    list_filter(stored, lambda x: not list_contains(list_transform(fresh, lambda y: y[1]), x[1])), fresh),
    lambda x: x[1] || ': ' || x[2])), chr(10)) end as headers,
  case when state = 'matched' then length(html) end as n_chars
from joined
"""

_OP8 = rf"""
with doc_words as (
  select doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents
), item_words as (
  select item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark
), windows as (
  select distinct item_id, len(w[i:i + 9]) as n, array_to_string(w[i:i + 9], ' ') as t
  from (select item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as i from item_words where len(w) > 0)
), lengths as (
  select distinct n from windows
), runs as (
  select doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') as t
  from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as i from doc_words, lengths where len(w) >= n)
), hits as (
  select r.doc_id, r.i, r.n, x.item_id from runs r join windows x on r.n = x.n and r.t = x.t
), covered as (
  select doc_id, count(distinct p) as n_hit
  from (select doc_id, unnest(range(i, i + n)) as p from (select distinct doc_id, i, n from hits)) group by doc_id
), found as (
  select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items
  from (select distinct doc_id, cast(item_id as varchar) as item from hits) group by doc_id
)
select d.doc_id, len(d.w) as n_words, coalesce(c.n_hit, 0) as n_hit, coalesce(f.n_items, 0) as n_items,
  sha256(coalesce(f.items, '')) as items_sha256, coalesce(c.n_hit, 0) > 0 as contaminated
from doc_words d left join covered c using (doc_id) left join found f using (doc_id)
"""

#: For pages of one article whose only entities are these; a block ends at any tag but an inline one.
_OP10 = r"""
with parts as (
  select page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)(</article>|<footer>|$)', 1) as a from pages
), blocks as (
  select page_id, url, list_transform(string_split(regexp_replace(regexp_replace(a,
      '</?(b|i|em|strong|span|a)(\s[^>]*)?>', '', 'g'), '<[^>]*>', chr(1), 'g'), chr(1)),
    lambda b: trim(regexp_replace(replace(replace(replace(replace(b,
      '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&amp;', '&'), '\s+', ' ', 'g'))) as b from parts
), texts as (
  select page_id, url, array_to_string(list_filter(b, lambda x: x <> ''), chr(10)) as text from blocks
)
select page_id, url, text, length(text) as n_chars from texts
"""

#: Two rounds of assignment and update, and a last assignment, each over the distances of all parts to all entries.
_OP11 = "with " + """
kept as (
  select row_number() over (order by vec_id nulls last, embedding) as r, vec_id, label, embedding as v from embeddings
  where coalesce(list_bool_and(list_transform(embedding, lambda x: x is not null and isfinite(x))), false) and len(embedding) > 0
), parts as (
  select r, vec_id, label, i * 16 // len(v) as p, i % (len(v) // 16) as j, cast(floor(256 * cast(v[i + 1] as double)) as bigint) as x
  from (select *, unnest(range(len(v))) as i from kept)
), book0 as (
  select p, r - 1 as e, j, x as c from parts where r <= 64
)""" + "".join(f""", far{t} as (
  select r, p, e, sum((x - c) * (x - c)) as d from parts join book{t} using (p, j) group by r, p, e
), code{t} as (
  select r, p, e, d from far{t} qualify row_number() over (partition by r, p order by d, e) = 1
)""" + (f""", sums{t} as (
  select p, e, j, sum(x) as s, count(*) as n from parts join code{t} using (r, p) group by p, e, j
), book{t + 1} as (
  select p, e, j, cast(coalesce((s - ((s % n) + n) % n) // n, c) as bigint) as c from book{t} left join sums{t} using (p, e, j)
)""" if t < 2 else "") for t in range(3)) + """, coded as (
  select r, string_agg(lower(lpad(to_hex(e), 2, '0')), '' order by p) as code, cast(sum(d) as bigint) as error from code2 group by r
), named as (
  select sha256(string_agg(cast(c as varchar), ',' order by p, e, j)) as codebooks_sha256 from book2
)
select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error, codebooks_sha256
from coded join kept using (r), named
"""

#: crc32 of a column, a byte and then a bit at a time.
_CRC = """xor(4294967295, list_reduce(list_prepend(4294967295::bigint, list_transform(string_split({0}, ''), lambda c: ascii(c)::bigint)),
    lambda s, b: list_reduce(list_prepend(xor(s, b), range(8)), lambda x, i: xor(x >> 1, (x & 1) * 3988292384))))"""


def _best(state: int) -> str:
    """The best of all that may be done from a state before a row: some insertions, then an edit of the row. n: what comes after."""
    follows, name = {0: 2, 1: 2, 2: 3, 3: 2}, {2: "user", 3: "assistant"}
    kept = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
    options, at, before = [], state, []
    for _ in range(3):
        paid, edits = 2 * len(before), "I" * len(before)
        lines = "[" + ", ".join(f"'{x}:'" for x in before) + "]::varchar[]"

        def option(cost, edit, to, line, when):
            found = f"""{{'cost': {paid} + {cost} + n.s{to}.cost, 'audit': '{edits}{edit}' || n.s{to}.audit,
              'lines': list_concat({lines}, {line}, n.s{to}.lines)}}"""
            return found if when is None else f"case when {when} then {found} end"

        options.append(option(3, "D", at, "[]::varchar[]", None))
        for letter, ways in kept.items():
            if at in ways:
                options.append(option("stays", "K", ways[at], "[role || ':' || text]", f"fault in ('k', 't') and role[1] = '{letter}'"))
        to = follows[at]
        options.append(option("2 + stays", "R", to, f"['{name[to]}:' || text]", "fault in ('k', 't')"))
        before, at = [*before, name[to]], to
    return f"list_min(list_filter([{', '.join(options)}], lambda x: x is not null and x.cost < 1000000))"


_OP12 = rf"""
with recursive named as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
    coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' ') as k from conversations
), hit as (
  select *, {_CRC.format("k")} % 20 as f from named
), damaged as (
  select conv_id, turn, case when f = 4 then 'user' else role end as role,
    case when f = 1 then '' when f = 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text
  from (select *, unnest(range(case when f = 3 then 2 else 1 end)) as copy from hit where f <> 0)
), turns as (
  select *, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as shown,
    row_number() over (partition by conv_id order by turn nulls first, role, left(text, 64), md5(text)) as i,
    row_number() over (partition by conv_id, role, text) as nth
  from damaged
), faulty as (
  select * exclude (nth), case when shown = '' then 'b' when first < i then 'd' when right(shown, 1) not in ('.', '!', '?') then 't' else 'k' end as fault
  from (select *, min(i) over (partition by conv_id, role, text) as first, lag(role[1]) over (partition by conv_id order by i) as before from turns)
), rows_ as (
  select *, case when fault = 't' then 1 else 0 end as stays from faulty
), after_ as (
  select conv_id, max(i) + 1 as i,
    {{'cost': 0, 'audit': '', 'lines': []::varchar[]}} as s0, {{'cost': 4, 'audit': 'II', 'lines': ['user:', 'assistant:']}} as s1,
    {{'cost': 2, 'audit': 'I', 'lines': ['assistant:']}} as s2, {{'cost': 0, 'audit': '', 'lines': []::varchar[]}} as s3
  from rows_ group by conv_id
  union all
  select r.conv_id, r.i, {_best(0)}, {_best(1)}, {_best(2)}, {_best(3)}
  from after_ n join rows_ r on r.conv_id is not distinct from n.conv_id and r.i = n.i - 1
), counted as (
  select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (fault = 'b') as blank,
    count(*) filter (fault = 'd') as duplicate, count(*) filter (fault = 't') as truncated,
    count(*) filter (before is not null and before || role[1] not in ('su', 'ua', 'au')) as illegal
  from rows_ group by conv_id
), repaired as (
  select conv_id, s0.cost as cost, s0.audit as audit, sha256(array_to_string(s0.lines, chr(10))) as sha from after_ where i = 1
)
select o.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate, coalesce(truncated, 0) as truncated,
  coalesce(illegal, 0) as illegal, cast(coalesce(cost, 0) as bigint) as cost, coalesce(audit, '') as audit, coalesce(sha, sha256('')) as repaired_sha256
from (select distinct conv_id from conversations) o
left join counted c on c.conv_id is not distinct from o.conv_id left join repaired r on r.conv_id is not distinct from o.conv_id
"""

ORACLE: dict[str, str] = {
    "op2_chat_format": _OP2,
    "op4_odd_sketch_dedup": _OP4,
    "op5_projection_dedup": _OP5,
    "op7_warc_revisit": _OP7,
    "op8_phrase_index": _OP8,
    "op10_html_region": _OP10,
    "op11_vector_codes": _OP11,
    "op12_turn_repair": _OP12,
}
