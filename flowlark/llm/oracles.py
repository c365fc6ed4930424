"""SQL that states the results of the operators which SQL can express."""

from flowlark.llm import importance, line_rules, mixing
from flowlark.llm.common import GAP, WORD


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def _chars(text: str) -> str:
    """A literal of characters, control characters by their number."""
    parts = ["chr(%d)" % ord(c) if ord(c) < 32 else _quoted(c) for c in text]
    return "(" + " || ".join(parts) + ")"


def _counted(characters: str) -> str:
    return f"(length(line) - length(translate(line, {_chars(characters)}, '')))"


LINE_RULES = f"""
with d as (select doc_id, coalesce(text, '') as t from documents),
w as (select doc_id, t, regexp_extract_all(t, '{WORD}') as ws from d),
g as (
  select doc_id, i, ws[i : i + {line_rules.WINDOW - 1}] as words
  from (select doc_id, ws, unnest(range(1, len(ws) - {line_rules.WINDOW - 2})) as i
        from w where len(ws) >= {line_rules.WINDOW})),
twice as (
  select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, words) as n from g)
  where n > 1),
covered as (
  select doc_id, count(distinct i + j) as n from twice, range({line_rules.WINDOW}) r(j) group by 1),
x as (
  select doc_id, unnest(range(len(ls))) as i, unnest(ls) as line
  from (select doc_id, string_split(t, chr(10)) as ls from d)),
l as (
  select doc_id, i, line, len(regexp_extract_all(line, '{WORD}')) as n,
    length(translate(line, {_chars(line_rules.BLANKS)}, '')) as solid, {_counted(line_rules.MARKUP)} as markup,
    len(regexp_extract_all(line, {_quoted(line_rules.SHOUTS)})) as shouts,
    {_counted(line_rules.SEPARATORS)} as parts, {_counted(line_rules.MARKS)} as marks,
    rtrim(line, {_chars(line_rules.CLOSERS + line_rules.BLANKS)}) as trimmed,
    length(lower(line)) - length(regexp_replace(lower(line), {_quoted(line_rules.BOILERPLATE)}, '', 'g')) as told
  from x),
e as (
  select *, trimmed <> '' and contains({_chars(line_rules.ENDS)}, right(trimmed, 1)) as ended,
    coalesce(lag(n) over o, 0) as n1, coalesce(lag(n, 2) over o, 0) as n2,
    coalesce(lead(n) over o, 0) as n3, coalesce(lead(n, 2) over o, 0) as n4,
    coalesce(lag(marks) over o, 0) as m1, coalesce(lag(marks, 2) over o, 0) as m2,
    coalesce(lead(marks) over o, 0) as m3, coalesce(lead(marks, 2) over o, 0) as m4
  from l window o as (partition by doc_id order by i)),
f as (
  select *, coalesce(n1 > 2 and not lag(ended) over (partition by doc_id order by i), false) as goes_on,
    1 + (n1 > 0)::int + (n1 > 0 and n2 > 0)::int + (n3 > 0)::int + (n3 > 0 and n4 > 0)::int as passage,
    n + n1 + if(n1 > 0, n2, 0) + n3 + if(n3 > 0, n4, 0) as words,
    marks + if(n1 > 0, m1 + if(n2 > 0, m2, 0), 0) + if(n3 > 0, m3 + if(n4 > 0, m4, 0), 0) as stops
  from e),
j as (
  select *, passage >= 2 and words >= {line_rules.LINE_WORDS} * passage and stops * {line_rules.MARK_WORDS} >= words as running,
    not (markup * 5 > solid or shouts * 2 > n
      or (n < 10 and marks = 0 and not running)
      or (parts >= 3 and parts * 5 > n)
      or (n <= 2 and not ended and not (goes_on and running))
      or (n <= 30 and told > 0 and (told * 5 >= length(line) * 4 or (told * 3 >= length(line) and not running)))) as good
  from f where n > 0),
s as (
  select doc_id, count(*) - count(distinct line) as n_dup_lines, sum(length(line))::bigint as line_chars,
    coalesce(sum(length(line)) filter (good), 0)::bigint as kept_chars,
    count(*) filter (not good) as n_lines_removed
  from j group by 1),
r as (
  select w.doc_id, len(ws)::bigint as n_words,
    length(regexp_replace(t, '{GAP}', '', 'g'))::bigint as word_chars,
    (length(t) - length(translate(t, {_chars(line_rules.SYMBOLS)}, '')))::bigint as n_symbols,
    coalesce(n_dup_lines, 0)::bigint as n_dup_lines, coalesce(covered.n, 0)::bigint as n_repeat_words,
    coalesce(line_chars, 0)::bigint as line_chars, coalesce(kept_chars, 0)::bigint as kept_chars,
    coalesce(n_lines_removed, 0)::bigint as n_lines_removed
  from w left join s on s.doc_id = w.doc_id left join covered on covered.doc_id = w.doc_id),
b as (select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed from r)
select *, not base_failed and 100 * kept_chars >= 60 * line_chars as kept from b
"""

MIXING = f"""
with d as (
  select doc_id, source as s, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::bigint as size,
    (('0x' || left(md5(coalesce(doc_id::varchar, '') || ':17'), 13))::bigint + 0.5) / {float(1 << 52)}::double as u
  from documents),
t as (select *, length(bin(size)) as c from d),
src as (
  select s, sum(size)::bigint as size, row_number() over (order by s is null, s) - 1 as place from t group by s),
wsrc as (select *, [3.0, 1.0, 2.0][place % 3 + 1]::double as w from src),
cum as (
  select *, sum(size) over o - size as size_before, sum(w) over o - w as w_before,
    sum(size) over () as size_all, sum(w) over () as w_all,
    row_number() over (order by size / w, place) as rk
  from wsrc window o as (order by size / w, place rows unbounded preceding)),
cap as (
  select *, 1.5 * size_all - 2.0 * size_before as room, w_all - w_before as free,
    (1.5 * size_all - 2.0 * size_before) * w > 2.0 * size * (w_all - w_before) as capped from cum),
lv as (select coalesce(arg_min(room / free, rk) filter (not capped), 0.0) as level from cap),
tg as (
  select s, size as source_size, case when capped then 2.0 * size else level * w end as target from cap, lv),
cl as (
  select t.s, c, sum(t.size)::bigint as words, any_value(target) as target
  from t join tg on tg.s is not distinct from t.s where t.size > 0 group by t.s, c),
cm as (
  select *, 1 + c * {mixing.TILT}::double as m,
    target - 2.0 * (sum(words) over o - words) as room,
    sum((1 + c * {mixing.TILT}::double) * words) over (partition by s)
      - (sum((1 + c * {mixing.TILT}::double) * words) over o - (1 + c * {mixing.TILT}::double) * words) as free
  from cl window o as (partition by s order by c desc rows unbounded preceding)),
ce as (
  select s, c, words, target, least(2.0, coalesce(arg_max(
    case when room * m <= 2.0 * free then room / free end,
    case when room * m <= 2.0 * free then c end) over (partition by s) * m, 2.0)) as e from cm),
rest as (select s, any_value(target) - sum(floor(e) * words) as rest from ce group by s),
p as (
  select t.*, floor(e) as sure, case when e - floor(e) > 0 and size > 0 then
      u * (1 - (e - floor(e))) / (u * (1 - (e - floor(e))) + (1 - u) * (e - floor(e))) end as p
  from t left join ce on ce.s is not distinct from t.s and ce.c = t.c),
q as (
  select p.*, rest, sum(size) over (partition by p.s order by p) as upto
  from p join rest on rest.s is not distinct from p.s where p is not null),
cut as (
  select s, max(p) filter (upto <= rest) as cut, any_value(rest) - coalesce(max(upto) filter (upto <= rest), 0) as gap
  from q group by s having max(upto) > any_value(rest)),
clo as (
  select q.s, arg_min(p, row(abs(gap - size), p)) as closing from q join cut on cut.s is not distinct from q.s
  where p > coalesce(cut, -1.0) and abs(gap - size) < gap group by q.s),
n as (
  select p.*, case when size = 0 then 0 else sure + case when p is null then 0
      when gap is null or p <= coalesce(cut, -1.0) or p = closing then 1 else 0 end end as copies
  from p left join cut on cut.s is not distinct from p.s left join clo on clo.s is not distinct from p.s)
select doc_id, size, source_size, target, copies::bigint as copies, (copies * size)::bigint as taken
from n join tg on tg.s is not distinct from n.s
"""

#: CRC-32 of a text by its table, which the polynomial gives.
RESAMPLING = f"""
with recursive steps as (
  select b, 0 as k, b::ubigint as v from range(256) r(b)
  union all
  select b, k + 1, case when v & 1 = 1 then xor(v >> 1, 3988292384::ubigint) else v >> 1 end from steps where k < 8),
crcs as (select list(v order by b) as crc from steps where k = 8),
d as (select true as doc, doc_id as id, coalesce(text, '') as t from documents
  union all select false, item_id, coalesce(text, '') from benchmark),
w as (
  select doc, id, regexp_extract_all(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as ws from d),
g as (
  select doc, id, array_to_string(ws[i : i + k - 1], ' ') as f
  from (select doc, id, ws, k, unnest(range(1, len(ws) - k + 2)) as i
        from w, range(1, {importance.LONGEST + 1}) n(k) where len(ws) >= k)),
hex as (select f, hex(encode(f)) as h from (select distinct f from g)),
b as (
  select f, xor(list_reduce(
      [('0x' || h[i : i + 1])::ubigint for i in range(1, len(h), 2)],
      lambda c, x: xor(c >> 8, crc[(xor(c, x) & 255)::bigint + 1]), 4294967295::ubigint),
    4294967295::ubigint) % {importance.BUCKETS} as bucket
  from hex, crcs),
n as (select doc, id, bucket, count(*) as n from g join b using (f) group by all),
st as (
  select bucket, coalesce(sum(n) filter (doc), 0)::double as s, coalesce(sum(n) filter (not doc), 0)::double as t
  from n group by 1),
gain as (
  select bucket, floor(1000 * ln((t + 1) * (sum(s) over () + {importance.BUCKETS})
    / ((s + 1) * (sum(t) over () + {importance.BUCKETS}))))::bigint as gain from st),
weights as (select id, sum(n)::bigint as n_features, sum(n * gain)::bigint as weight
  from n join gain using (bucket) where doc group by 1),
scored as (
  select id as doc_id, len(ws) as n_words, coalesce(n_features, 0) as n_features, coalesce(weight, 0) as weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln(
      (('0x' || left(sha256('{importance.SEED}:' || id), 8))::bigint + 0.5) / 4294967296.0::double)))::bigint as score
  from w left join weights using (id) where doc),
ranked as (
  select *, row_number() over (partition by n_words >= 20 order by score desc, doc_id) as place,
    count(*) filter (n_words >= 20) over () as able from scored)
select doc_id, n_features, weight, score,
  case when n_words >= 20 and place <= able * 5 // 100 then place end as rank
from ranked
"""

WARC = """
with p as (select page_id, coalesce(html, '') as body from pages),
d as (
  select page_id, octet_length(encode(body))::bigint as payload_bytes, sha1(body) as h,
    max(page_id) over (partition by body) as top from p)
select page_id, payload_bytes,
  list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      ((('0x' || substr(h, 5 * (i // 4) + 1, 5))::bigint >> (15 - 5 * (i % 4))) & 31)::bigint + 1, 1)),
    'string_agg', '') as payload_digest,
  case when page_id = top then 'response' else 'revisit' end as record_type,
  case when page_id <> top then top end as refers_to
from d
"""
