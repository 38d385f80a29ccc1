"""DuckDB SQL of the operators' results, stated from their definitions."""

from __future__ import annotations

DIVERGENCE_RULES = r"""
with d as (
  select doc_id, lang, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws
  from documents
),
w as (select doc_id, lang, unnest(ws) as word, generate_subscripts(ws, 1) as pos from d),
runs as (
  select doc_id, i as pos, array_to_string(ws[i:i + 7], ' ') as run
  from (select doc_id, ws, unnest(range(1, greatest(len(ws) - 6, 1))) as i from d)
),
twice as (
  select doc_id, pos from (select doc_id, pos, count(*) over (partition by doc_id, run) as n from runs) where n > 1
),
repeats as (
  select doc_id, sum(least(8, coalesce(nxt - pos, 8)))::bigint as n_repeat_words
  from (select doc_id, pos, lead(pos) over (partition by doc_id order by pos) as nxt from twice) group by doc_id
),
lines as (
  select doc_id, (count(*) - count(distinct line))::bigint as n_dup_lines
  from (select doc_id, unnest(string_split(t, chr(10))) as line from d)
  where regexp_matches(line, '[^\x20\x09-\x0D]') group by doc_id
),
chars as (
  select doc_id, lang, c, length(c) as n_chars,
    length(regexp_replace(c, '[^a-z]+', '', 'g')) as lo,
    length(regexp_replace(c, '[^-.,;:''"?!()]+', '', 'g')) as st,
    length(regexp_replace(c, '[^A-Z]+', '', 'g')) as up,
    length(regexp_replace(c, '[^0-9]+', '', 'g')) as di,
    length(regexp_replace(c, '[^\x00-\x7F]+', '', 'g')) as ascii_
  from (select doc_id, lang, array_to_string(ws, '') as c from d)
),
classes as (
  select doc_id, lang, n_chars, unnest([1, 2, 3, 4, 5, 6]) as k,
    unnest([lo, st, up, di, ascii_ - lo - st - up - di, n_chars - ascii_])::double as n
  from chars
),
class_ref as (select lang, k, sum(n) as r, sum(sum(n)) over (partition by lang) as total from classes group by lang, k),
class_js as (
  select c.doc_id, any_value(n_chars) as n_chars, greatest(0, sum(
      case when n > 0 then n / n_chars * log2(2 * (n / n_chars) / (n / n_chars + r / total)) else 0 end
      + case when r > 0 then r / total * log2(2 * (r / total) / (n / n_chars + r / total)) else 0 end) / 2) as js
  from classes c join class_ref f on c.k = f.k and c.lang is not distinct from f.lang
  where n_chars > 0 group by c.doc_id
),
counted as (select lang, word, count(*) as c from w group by lang, word),
langs as (select lang, sum(c)::double as total from counted group by lang),
best as (select lang, word, c::double as c from counted qualify row_number() over (partition by lang order by c desc, word) <= 50),
sizes as (select doc_id, lang, len(ws) as n from d),
own as (select w.doc_id, w.word, count(*)::double as n from w join best b on w.word = b.word and w.lang is not distinct from b.lang group by 1, 2),
cells as (
  select s.doc_id, s.n, s.lang, b.c, coalesce(o.n, 0) as hits
  from sizes s join best b on s.lang is not distinct from b.lang left join own o on o.doc_id = s.doc_id and o.word = b.word
  where s.n > 0
),
bins as (
  select doc_id, n, lang, c as r, hits as h from cells
  union all
  select doc_id, n, x.lang, total - sum_c, n - sum_h
  from (select doc_id, n, lang, sum(c) as sum_c, sum(hits) as sum_h from cells group by doc_id, n, lang) x
  join langs l on x.lang is not distinct from l.lang
),
word_js as (
  select doc_id, any_value(n) as n, any_value(total) as total, count(*) as bins, greatest(0, sum(
      case when h > 0 then h / n * log2(2 * (h / n) / (h / n + r / total)) else 0 end
      + case when r > 0 then r / total * log2(2 * (r / total) / (h / n + r / total)) else 0 end) / 2) as js
  from bins b join langs l on b.lang is not distinct from l.lang group by doc_id
),
base as (
  select d.doc_id, len(d.ws)::bigint as n_words, coalesce(length(array_to_string(d.ws, '')), 0)::bigint as word_chars,
    length(regexp_replace(d.t, '[^#*$%&|<>]+', '', 'g'))::bigint as n_symbols,
    coalesce(l.n_dup_lines, 0) as n_dup_lines, coalesce(r.n_repeat_words, 0) as n_repeat_words,
    case when c.n_chars >= 200 and j.total >= 2000 then c.js end as cjs, c.n_chars,
    case when j.n >= 40 and j.total >= 2000 then j.js end as wjs, j.bins
  from d left join lines l using (doc_id) left join repeats r using (doc_id)
  left join class_js c using (doc_id) left join word_js j using (doc_id)
),
judged as (select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed from base)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed
    and not coalesce(sqrt(greatest(0, cjs - 5 / (8 * ln(2) * n_chars))) > 0.21, false)
    and not coalesce(sqrt(greatest(0, wjs - (bins - 1) / (8 * ln(2) * n_words))) > 0.33, false) as kept,
  round(sqrt(cjs), 6) as class_distance, round(sqrt(wjs), 6) as word_distance
from judged
"""

_TERMS = (
    "regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
)

RANKED_SEARCH = f"""
with d as (select doc_id, unnest({_TERMS}) as term from documents),
tf as (select doc_id, term, count(*) as tf from d group by doc_id, term),
lengths as (select doc_id, count(*) as n from d group by doc_id),
corpus as (select count(*) as docs, sum(n)::bigint as terms from lengths),
norms as (select doc_id, 100 - 25 + ((25 * n * docs) // terms) as m from lengths, corpus),
items as (select item_id, unnest({_TERMS}) as term from benchmark),
asked as (select item_id, term, count(*) as times from items group by item_id, term),
df as (select term, count(*) as df from tf where term in (select term from asked) group by term),
weights as (select term, floor(1000 * ln((2 * docs + 2) / (2 * df + 1)))::bigint as w from df, corpus),
scores as (
  select item_id, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::bigint as score
  from asked join weights using (term) join tf using (term) join norms using (doc_id)
  group by item_id, doc_id
),
ranked as (
  select item_id, row_number() over (partition by item_id order by score desc, doc_id)::int as rank, doc_id, score
  from scores where score > 0
)
select item_id, rank, doc_id, score from ranked where rank <= 20
"""

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"coalesce(regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), [])"

DECONTAMINATION = f"""
with d as (select doc_id, {_WORDS} as ws from documents),
items as (select item_id, {_WORDS} as ws from benchmark),
windows as (
  select distinct item_id, size, array_to_string(ws[i:i + size - 1], ' ') as phrase
  from (
    select item_id, ws, least(10, len(ws)) as size, unnest(range(1, len(ws) - least(10, len(ws)) + 2)) as i
    from items where len(ws) > 0
  )
),
places as (
  select doc_id, i, size, array_to_string(ws[i:i + size - 1], ' ') as phrase
  from (
    select doc_id, ws, size, unnest(range(1, greatest(len(ws) - size + 2, 1))) as i
    from d, (select distinct size from windows)
  )
),
hits as (
  select doc_id, i, size, item_id from places join windows using (size, phrase)
),
covered as (
  select doc_id, count(distinct word)::bigint as n_hit
  from (select doc_id, unnest(range(i, i + size)) as word from hits) group by doc_id
),
found as (
  select doc_id, count(*)::bigint as n_items, string_agg(item, ',' order by item) as names
  from (select distinct doc_id, item_id::varchar as item from hits where item_id is not null) group by doc_id
)
select doc_id, len(ws)::bigint as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(names, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join covered using (doc_id) left join found using (doc_id)
"""

REPEATS = """
with d as (select doc_id, hex(encode(coalesce(text, ''))) as h, strlen(coalesce(text, '')) as n from documents),
places as (select doc_id, h, unnest(range(0, greatest(n - 49, 0))) as pos from d),
hashed as materialized (select doc_id, pos, hash(substr(h, 2 * pos + 1, 100)) as k from places),
shared as materialized (select k from hashed group by k having min(doc_id) < max(doc_id)),
w as materialized (
  select doc_id, pos, substr(h, 2 * pos + 1, 100) as bytes from hashed semi join shared using (k) join d using (doc_id)
),
firsts as (select bytes, min(doc_id) as first_doc from w group by bytes having min(doc_id) < max(doc_id)),
gone as (select doc_id, pos from w join firsts using (bytes) where first_doc < doc_id),
marked as (
  select doc_id, pos, case when pos - lag(pos) over (partition by doc_id order by pos) <= 50 then 0 else 1 end as opens from gone
),
runs as (
  select doc_id, min(pos) as a, max(pos) + 50 as z
  from (select doc_id, pos, sum(opens) over (partition by doc_id order by pos) as run from marked) group by doc_id, run
),
gaps as (
  select doc_id, a, z, coalesce(lag(z) over (partition by doc_id order by a), 0) as prev_end from runs
),
cut as (
  select doc_id, sum(z - a)::bigint as n_removed, count(*)::bigint as n_spans, max(z) as last_end,
    string_agg(substr(h, 2 * prev_end + 1, 2 * (a - prev_end)), '' order by a) as head
  from gaps join d using (doc_id) group by doc_id
)
select doc_id, n::bigint as n_bytes, coalesce(n_removed, 0) as n_removed, coalesce(n_spans, 0) as n_spans,
  sha256(unhex(coalesce(head, '') || substr(h, 2 * coalesce(last_end, 0) + 1))) as kept_sha256
from d left join cut using (doc_id)
"""
