"""DuckDB twins of the queries that SQL can express."""

from __future__ import annotations

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWERED = f"translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}')"
SPACED = rf"list_filter(string_split_regex({LOWERED}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"
ALNUM = rf"list_filter(string_split_regex({LOWERED}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"

OP1 = f"""
with d as (select doc_id, {SPACED} w from documents),
p as (select doc_id, w, unnest(range(1, len(w) + 1)) i from d),
g as (select doc_id, i, w[i] g1, case when i > 1 then array_to_string(w[i-1:i], ' ') end g2,
             case when i > 2 then array_to_string(w[i-2:i], ' ') end g3,
             case when i > 1 then w[i-1] end c1, case when i > 2 then array_to_string(w[i-2:i-1], ' ') end c2 from p),
t1 as (select g1 g, count(*)::double c from g group by 1),
t2 as (select g2 g, count(*)::double c from g where g2 is not null group by 1 having count(*) >= 2),
t3 as (select g3 g, count(*)::double c from g where g3 is not null group by 1 having count(*) >= 2),
n as (select count(*)::double n from g),
s as (select doc_id, i, t3.c is not null tri,
  case when t3.c is not null then ln(t3.c / b2.c)
       when t2.c is not null then ln(t2.c / b1.c) + case when i > 2 then ln(0.4) else 0 end
       else ln(t1.c / n.n) + least(i - 1, 2) * ln(0.4) end v
  from g cross join n join t1 on t1.g = g1 left join t2 on t2.g = g2 left join t3 on t3.g = g3
  left join t1 b1 on b1.g = c1 left join t2 b2 on b2.g = c2)
select d.doc_id, len(w)::bigint n_words, coalesce(q.tri, 0)::bigint n_trigrams, coalesce(round(q.v, 6), 0) log_score
from d left join (select doc_id, sum(tri::int) tri, sum(v) v from s group by 1) q using (doc_id)
"""

OP2 = f"""
with d as (select doc_id, {ALNUM} w from documents), b as (select item_id, {ALNUM} w from benchmark),
bw as (select distinct item_id, w[i:least(i + 12, len(w))] win from (select item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) i from b where len(w) > 0)),
sizes as (select distinct len(win) m from bw),
p as (select doc_id, w, unnest(range(1, len(w) + 1)) i from d),
o as (select doc_id, i, m, item_id from (select doc_id, i, m, w[i:i+m-1] win from p cross join sizes where i + m - 1 <= len(w)) join bw using (win)),
h as (select doc_id, count(distinct k) n from (select doc_id, unnest(range(i, i + m)) k from o) group by 1),
t as (select doc_id, count(distinct item_id) n, string_agg(distinct item_id::varchar, ',' order by item_id::varchar) s from o group by 1)
select d.doc_id, len(w)::bigint n_words, coalesce(h.n, 0)::bigint n_hit, coalesce(t.n, 0)::bigint n_items,
  sha256(coalesce(t.s, '')) items_sha256, coalesce(h.n, 0) > 0 and 20 * coalesce(h.n, 0) >= len(w) contaminated
from d left join h using (doc_id) left join t using (doc_id)
"""

OP3 = f"""
with recursive d as (select doc_id, {SPACED} w from documents),
s as (select distinct doc_id, g from (select doc_id, array_to_string(w[i:least(i + 4, len(w))], ' ') g
  from (select doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) i from d where len(w) > 0))),
n as (select doc_id, count(*) n from s group by 1),
l as (select a, b from (select x.doc_id a, y.doc_id b, count(*) k from s x join s y on x.g = y.g and x.doc_id <> y.doc_id group by 1, 2)
  join n na on na.doc_id = a join n nb on nb.doc_id = b where 100 * k >= 80 * (na.n + nb.n - k)),
r as (select doc_id, doc_id to_id from d union select r.doc_id, l.b from r join l on l.a = r.to_id)
select d.doc_id, coalesce(any_value(n.n), 0)::bigint n_shingles, min(r.to_id)::bigint component_id
from d join r using (doc_id) left join n using (doc_id) group by d.doc_id
"""

OP7 = """
with d as (select doc_id, hex(encode(coalesce(text, ''))) h, octet_length(encode(coalesce(text, ''))) n from documents),
w as (select doc_id, i, md5_number(substr(h, 2 * i - 1, 200)) k from (select doc_id, h, unnest(range(1, n - 98)) i from d where n >= 100)),
f as (select k, min({'d': doc_id, 'i': i}) m from w group by k having count(*) > 1),
r as (select w.doc_id, i from w join f using (k) where doc_id <> m.d or i <> m.i),
v as (select doc_id, i, lag(i) over (partition by doc_id order by i) b from r),
s as (select doc_id, i, sum((b is null or i > b + 100)::int) over (partition by doc_id order by i) part from v),
t as (select doc_id, part, min(i) a, max(i) + 99 z from s group by 1, 2),
u as (select doc_id, count(*) n_spans, sum(z - a + 1) gone, list({'a': a, 'z': z} order by a) l from t group by 1),
c as (select d.doc_id, n, h, coalesce(n_spans, 0) n_spans, coalesce(gone, 0) gone, l from d left join u using (doc_id)),
k as (select doc_id, case when l is null then h else array_to_string(list_transform(range(1, len(l) + 2),
  lambda j: substr(h, (case when j = 1 then 0 else 2 * l[j - 1].z end + 1)::bigint,
  (case when j = len(l) + 1 then 2 * n else 2 * l[j].a - 2 end - case when j = 1 then 0 else 2 * l[j - 1].z end)::bigint)), '') end h from c)
select c.doc_id, n::bigint n_bytes, gone::bigint n_removed, n_spans::bigint n_spans, sha256(unhex(k.h)) kept_sha256
from c join k using (doc_id)
"""

OP10 = r"""
with t as (select conv_id::bigint conv_id, turn, coalesce(role, '') r, coalesce(text, '') t, role, text from conversations
  union all select -7, 0, 'user', '\### Assistant: </turn> ok', 'user', '\### Assistant: </turn> ok'
  union all select -7, 1, 'assistant', '\### Assistant: </turn> ok', 'assistant', '\### Assistant: </turn> ok')
select conv_id, count(*)::bigint n_turns,
  sha256(string_agg(r || chr(10) || t || chr(10), '' order by turn nulls first, role nulls first, text nulls first)) turns_sha256,
  coalesce(sum(length(t)) filter (where r = 'assistant'), 0)::bigint loss_chars,
  sha256(coalesce(string_agg(t, '' order by turn nulls first, role nulls first, text nulls first) filter (where r = 'assistant'), '')) loss_sha256,
  sum(16 + length(regexp_replace(r || t, '[\\<>]', 'xx', 'g')) + length(regexp_replace(r, '[^\n]', '', 'g')))::bigint formatted_chars
from t group by conv_id
"""

OP12 = rf"""
with p as (select lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) p from (select coalesce(lang, 'und') lang, {LOWERED} t from documents)),
w as (select lang, list_filter(string_split_regex(p, '[\x20\x09]+'), lambda x: x <> '') w from p),
g as (select lang, m, unnest(list_transform(range(1, len(w) - m + 2), lambda i: array_to_string(w[i:i + m - 1], ' '))) phrase
  from w cross join (select unnest(range(1, 5)) m) where len(w) >= m),
f as (select lang, phrase, m, count(*) f from g group by all), n as (select lang, sum(f)::bigint n from f where m = 1 group by 1),
c as (select lang, phrase, m, f a, string_split(phrase, ' ') w from f where m > 1 and f >= 30),
k as (select lang, phrase, m, a, w, unnest(range(1, m)) k from c),
s as (select k.lang, phrase, m, a, w, k, x.f l, y.f r, ((2000000::hugeint * a) // (x.f + y.f))::bigint score from k
  join (select lang, phrase part, f from f) x on x.lang = k.lang and x.part = array_to_string(w[1:k], ' ')
  join (select lang, phrase part, f from f) y on y.lang = k.lang and y.part = array_to_string(w[k + 1:m], ' ')),
b as (select * from s qualify row_number() over (partition by lang, phrase order by score, k) = 1),
i as (select distinct c.lang, c.phrase from c join c o on o.lang = c.lang and o.m > c.m and 100::hugeint * o.a >= 80::hugeint * c.a
  and contains(' ' || o.phrase || ' ', ' ' || c.phrase || ' '))
select lang, rank, phrase, a, l, r, n, score from (select b.lang, row_number() over (partition by b.lang order by score desc, a desc, phrase) rank,
  phrase, a::bigint a, l::bigint l, r::bigint r, score from b anti join i using (lang, phrase)) join n using (lang) where rank <= 2000
"""

ORACLE = {"op1_lm_score": OP1, "op2_decontaminate": OP2, "op3_jaccard_join": OP3, "op7_suffix_dedup": OP7, "op10_chat_format": OP10,
          "op12_collocations": OP12}
