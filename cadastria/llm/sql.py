"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from cadastria.llm import chat, overlap, rules, suffixes, trigrams

#: DuckDB: words of a text, and ratios with the same bounds as the threshold table.
SPLIT = r"[\x20\x09-\x0D]+"


def verdict(rule: rules.Rule) -> str:
    bounds = [f"100 * {rule.part} {op} {bound} * {rule.whole}"
              for op, bound in ((">=", rule.least), ("<=", rule.most)) if bound is not None]
    return " and ".join(bounds)


def rules_ctes(docs: str = "documents") -> str:
    """CTEs up to ``judged``: the columns of ``docs``, the counts, base_failed and kept."""
    stop = ", ".join(f"'{w}'" for w in rules.STOP_WORDS)
    return f"""
rule_docs as (select row_number() over () as rid, * from {docs}),
rule_words as (
  select rid, coalesce(text, '') as body,
    list_filter(string_split_regex(coalesce(text, ''), '{SPLIT}'), lambda w: w <> '') as ws,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) as ls
  from rule_docs),
rule_windows as (
  select rid, i, ws[i] as a, ws[i + 1] as b, ws[i + 2] as c
  from (select rid, ws, unnest(range(1, len(ws) - 1)) as i from rule_words where len(ws) > 2)),
rule_repeats as (
  select rid, count(distinct p) as n_repeat_words from (
    select rid, unnest([i, i + 1, i + 2]) as p
    from (select *, count(*) over (partition by rid, a, b, c) as times from rule_windows) where times > 1)
  group by rid),
rule_counts as (
  select d.*, len(ws)::bigint as n_words, coalesce(list_sum(list_transform(ws, lambda w: length(w))), 0)::bigint as word_chars,
    length(regexp_replace(body, '[^{rules.SYMBOLS}]', '', 'g'))::bigint as n_symbols,
    len(list_filter(ws, lambda w: rtrim(lower(w), '.,') in ({stop})))::bigint as n_stop_words,
    len(ls)::bigint as n_lines, (len(ls) - len(list_distinct(ls)))::bigint as n_dup_lines,
    coalesce(n_repeat_words, 0)::bigint as n_repeat_words
  from rule_docs d join rule_words using (rid) left join rule_repeats using (rid)),
judged as (
  select *, n_words < {rules.MIN_WORDS} or 100 * n_repeat_words > {rules.MAX_REPEAT_PERCENT} * n_words as base_failed,
    not (n_words < {rules.MIN_WORDS} or 100 * n_repeat_words > {rules.MAX_REPEAT_PERCENT} * n_words)
      and {' and '.join(verdict(r) for r in rules.RULES)} as kept
  from rule_counts)"""


CLASH = "<|im_end|><|im_start|>assistant ok"

CHAT = f"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all values (-1, 0, 'user', '{CLASH}'), (-1, 1, 'assistant', '{CLASH}')),
written as (
  select *, case when contains(text, '{chat.START}') or contains(text, '{chat.END}') or regexp_matches(text, '<\\\\+\\|')
    then len(regexp_extract_all(text, '<\\\\*\\|')) else 0 end as escapes
  from turns)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
  coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (role = 'assistant'), '')) as loss_sha256,
  sum({len(chat.START) + len(chat.END) + 2} + length(role) + length(text) + escapes)::bigint as formatted_chars
from written group by conv_id"""

REPEATS = f"""
with d as (
  select row_number() over () as rid, doc_id, hex(encode(coalesce(text, ''))) as h,
    octet_length(encode(coalesce(text, '')))::bigint as n from documents),
strings as (
  select rid, i, hash(substr(h, 2 * i + 1, {2 * suffixes.LENGTH})) as k
  from (select rid, h, unnest(range(0, greatest(n - {suffixes.LENGTH - 1}, 0))) as i from d)),
again as (select rid, i from (select rid, i, count(*) over (partition by k) as c from strings) where c > 1),
steps as (
  select rid, i, case when i <= lag(i) over (partition by rid order by i) + {suffixes.LENGTH} then 0 else 1 end as begins
  from again),
runs as (
  select rid, min(i) as a, max(i) + {suffixes.LENGTH} as b
  from (select rid, i, sum(begins) over (partition by rid order by i) as run from steps) group by rid, run),
gaps as (select *, lag(b, 1, 0) over (partition by rid order by a) as before from runs),
cut as (
  select rid, sum(b - a)::bigint as n_removed, count(*) as n_spans, max(b) as last,
    string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' order by a) as rest
  from gaps join d using (rid) group by rid)
select doc_id, n as n_bytes, coalesce(n_removed, 0) as n_removed, coalesce(n_spans, 0) as n_spans,
  sha256(unhex(case when n_spans is null then h else rest || substr(h, 2 * last + 1) end)) as kept_sha256
from d left join cut using (rid)"""

LINKS = f"""
with recursive words as (
  select row_number() over () as rid, doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{SPLIT}'),
    lambda w: w <> '') as ws
  from documents),
places as (
  select rid, ws, unnest(case when len(ws) >= {overlap.WORDS} then range(1, len(ws) - {overlap.WORDS - 2})
    when len(ws) > 0 then [1] else [] end) as i from words),
shingles as (select distinct rid, array_to_string(ws[i:i + {overlap.WORDS - 1}], ' ') as s from places),
sizes as (select rid, count(*) as n from shingles group by rid),
shared as (
  select a.rid as x, b.rid as y, count(*) as k from shingles a join shingles b on a.s = b.s and a.rid <> b.rid
  group by a.rid, b.rid),
links as (
  select x, y from shared join sizes p on p.rid = x join sizes q on q.rid = y
  where 100 * k >= {overlap.PERCENT} * (p.n + q.n - k)),
reached as (select x, y from links union select r.x, l.y from reached r join links l on l.x = r.y)
select w.doc_id, coalesce(any_value(z.n), 0)::bigint as n_shingles, least(w.doc_id, min(v.doc_id)) as component_id
from words w left join sizes z using (rid) left join reached r on r.x = w.rid left join words v on v.rid = r.y
group by w.rid, w.doc_id"""

FILL_IN_MIDDLE = """
with docs as (
  select doc_id, coalesce(text, '') as t, sha256('7:' || coalesce(doc_id::varchar, '')) as h,
    regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') as lines from documents),
drawn as (
  select *, len(lines) as n, ('0x' || substr(h, 1, 8))::bigint % (len(lines) + 1) as a,
    ('0x' || substr(h, 9, 8))::bigint % (len(lines) + 1) as b,
    t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') as plain,
    ('0x' || substr(h, 25, 8))::bigint % 100 < 50 as spm from docs),
parts as (
  select *, array_to_string(lines[1:least(a, b)], '') as p,
    array_to_string(lines[least(a, b) + 1:greatest(a, b)], '') as m,
    array_to_string(lines[greatest(a, b) + 1:n], '') as s from drawn)
select doc_id, n::bigint as n, case when plain then 'plain' when spm then 'spm' else 'psm' end as form,
  case when not plain then length(p) end::bigint as prefix_chars,
  case when not plain then length(m) end::bigint as middle_chars,
  sha256(case when plain then t when spm then '<S>' || s || '<P>' || p || '<M>' || m
    else '<P>' || p || '<S>' || s || '<M>' || m end) as output_sha256,
  sha256(t) as restored_sha256
from parts"""



def any_case(pattern: str) -> str:
    """``pattern`` with the letters outside its classes in either ASCII case."""
    out, inside = [], False
    for i, c in enumerate(pattern):
        inside = c == "[" or inside and c != "]"
        escaped = i > 0 and pattern[i - 1] == "\\" or pattern[i - 3:i - 1] == "\\x" or pattern[i - 2:i] == "\\x"
        out.append(f"[{c.upper()}{c.lower()}]" if c.isalpha() and not inside and not escaped else c)
    return "".join(out)


def secrets_sql() -> str:
    """Spans from the matches of each rule and the text between them."""
    found = []
    for k, rule in enumerate(trigrams.RULES):
        p = (any_case(rule.pattern) if rule.any_case else rule.pattern).replace("'", "''")
        found.append(f"select rid, {k} as k, '{rule.kind}' as kind, regexp_extract_all(t, '{p}') as m, "
                     f"regexp_extract_all(t, '{p}', {rule.group}) as v, string_split_regex(t, '{p}') as g, {rule.least} as least from docs")
    counts = ", ".join(f"coalesce(count(*) filter (k = {k}), 0)::bigint as n_{r.kind}" for k, r in enumerate(trigrams.BASE))
    return f"""
with docs as (select row_number() over () as rid, doc_id, coalesce(text, '') as t from documents),
found as ({' union all '.join(found)}),
each as (select *, unnest(range(1, len(m) + 1)) as i from found where len(m) > 0),
placed as (
  select *, (list_sum(list_transform(g[1:i], lambda x: length(x)))
    + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0))::bigint as a
  from each where length(v[i]) >= least),
spans as (select rid, k, a, kind || ':' || a || ':' || (a + length(m[i])) as s from placed),
per_doc as (
  select rid, {counts}, string_agg(s, ',' order by a, k) as spans,
    string_agg(s, ',' order by a, k) filter (k < {len(trigrams.BASE)}) as base
  from spans group by rid)
select doc_id, {', '.join(f'coalesce(n_{r.kind}, 0)::bigint as n_{r.kind}' for r in trigrams.BASE)},
  sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
from docs left join per_doc using (rid)"""


#: CRC-32 of the decimal digits of ``conv_id``, bit by bit.
CRC32 = """xor(4294967295, list_reduce(list_prepend(4294967295::bigint,
    list_transform(string_split(conv_id::varchar, ''), lambda c: unicode(c)::bigint)), lambda a, b: list_reduce(
      list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]::bigint[]),
      lambda s, z: case when (s & 1) = 1 then xor(s >> 1, 3988292384) else s >> 1 end)))"""

TRIE = f"""
with turns as (
  select conv_id, turn, length(coalesce(text, ''))::bigint as n,
    substr(sha256(length(coalesce(role, ''))::varchar || ':' || coalesce(role, '') || coalesce(text, '')), 1, 32) as h
  from conversations where conv_id is not null),
own as (
  select conv_id, list(h order by turn nulls first, h, n) as hs, list(n order by turn nulls first, h, n) as ns
  from turns group by conv_id),
drawn as (
  select o.conv_id, o.hs, o.ns, coalesce(b.hs, []) as bh, coalesce(b.ns, []) as bn, ({CRC32.replace('conv_id', 'o.conv_id')} % 6)::bigint as k
  from own o left join own b on b.conv_id = o.conv_id - ((o.conv_id % 100) + 100) % 100),
rebuilt as (
  select conv_id, list_concat(bh[1:k], hs[k + 1:len(hs)]) as hs, list_concat(bn[1:k], ns[k + 1:len(ns)]) as ns from drawn),
prefixes as (
  select conv_id, d, len(hs) as size, array_to_string(hs[1:d], '') as key, coalesce(ns[d], 0) as n
  from (select *, unnest(range(0, len(hs) + 1)) as d from rebuilt)),
nodes as (
  select key, d, min(conv_id) as conv_id, count(*) as n_convs, any_value(n) as n,
    string_agg(conv_id::varchar, ',' order by conv_id) filter (size = d) as ends
  from prefixes group by key, d),
kids as (select substr(key, 1, 32 * (d - 1)) as key, d - 1 as d, count(*) as n_children from nodes where d > 0 group by 1, 2),
counted as (select n.*, coalesce(n_children, 0)::bigint as n_children from nodes n left join kids using (key, d)),
lines as (select *, unnest(range(0, d + 1)) as up from counted),
below as (
  select substr(key, 1, 32 * up) as key, up as d, (count(*) filter (n_children = 0))::bigint as n_leaves,
    sum((n_convs - 1) * n)::bigint as saved_tokens from lines group by 1, 2)
select c.conv_id, c.d::bigint as depth, p.conv_id as parent_conv_id, c.n_convs, c.n_children, n_leaves, saved_tokens,
  sha256(coalesce(c.ends, '')) as ends_sha256
from counted c join below b on b.key = c.key and b.d = c.d
left join nodes p on p.d = c.d - 1 and p.key = substr(c.key, 1, 32 * (c.d - 1))"""

#: The given pages mark one article each, whose markup is plain, and no part of theirs is the site's.
ARTICLES = r"""
with articles as (
  select page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)</article>', 1) as h from pages),
bare as (
  select page_id, url, regexp_replace(regexp_replace(regexp_replace(h, '(?s)<!--.*?-->', '', 'g'), '</?b>', '', 'g'),
    '<[^>]*>', ' ', 'g') as t from articles),
decoded as (
  select page_id, url, trim(regexp_replace(replace(replace(replace(replace(replace(t, '&lt;', '<'), '&gt;', '>'),
    '&quot;', '"'), '&#x27;', chr(39)), '&amp;', '&'), '[\x20\x09-\x0D]+', ' ', 'g')) as text from bare)
select page_id, url, text, length(text)::bigint as n_chars from decoded"""

ORACLE: dict[str, str] = {
    "op6_sitetree": ARTICLES,
    "op7_chat": CHAT,
    "op8_suffixes": REPEATS,
    "op9_rules": f"with {rules_ctes()} select doc_id, {', '.join(rules.COUNTS)}, base_failed, kept from judged",
    "op10_overlap": LINKS,
    "op11_fill_in_middle": FILL_IN_MIDDLE,
    "op12_trigram_secrets": secrets_sql(),
    "op13_prefix_trie": TRIE,
}
