"""DuckDB texts for the queries that SQL can express."""

# Quality rules: the same counts from lists, lines compared as texts.
LINE_QUALITY = r"""
with d as (
  select doc_id, source, coalesce(text, '') as t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws
  from documents),
windows as (
  select doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] as g
  from (select doc_id, ws, unnest(range(1, len(ws) - 1)) as i from d where len(ws) > 2)),
twice as (select doc_id, g from windows group by all having count(*) > 1),
covered as (
  select doc_id, count(distinct p) as n
  from (select doc_id, unnest([i, i + 1, i + 2]) as p from windows join twice using (doc_id, g)) group by doc_id),
split_lines as (
  select doc_id, source, l,
         lower(array_to_string(regexp_extract_all(l, '[^\x20\x09-\x0D]+'), ' ')) as n,
         len(regexp_extract_all(l, '[^\x20\x09-\x0D]+')) as words
  from (select doc_id, source, unnest(string_split(t, chr(10))) as l from d)),
used as (select * from split_lines where words > 0),
repeats as (select doc_id, count(*) - count(distinct l) as n from used group by doc_id),
frequent as (
  select u.source, n, min(doc_id) as first_doc
  from used u join (select source as host, count(*) as docs from d group by source) on source is not distinct from host
  group by u.source, n, words, docs
  having count(distinct doc_id) > if(words >= 20, 4, 20) and 1000 * count(distinct doc_id) > if(words >= 20, 2, 50) * docs),
lost as (
  select u.doc_id, sum(u.words) as n from used u join frequent f
  on u.n = f.n and u.source is not distinct from f.source and u.doc_id <> f.first_doc group by u.doc_id),
counted as (
  select d.doc_id, len(ws)::bigint as n_words,
         length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::bigint as word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]'))::bigint as n_symbols,
         coalesce(r.n, 0)::bigint as n_dup_lines, coalesce(c.n, 0)::bigint as n_repeat_words,
         (len(ws) - coalesce(o.n, 0))::bigint as n_left
  from d left join covered c using (doc_id) left join repeats r using (doc_id) left join lost o using (doc_id))
select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
       not (n_words < 50 or 100 * n_repeat_words > 50 * n_words) and n_left >= 0.3::double * n_words as kept
from counted
"""

# Mixing: targets by water level, ranks by a window over each source.
MIXING = r"""
with s as (
  select doc_id, source, text, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size,
         (('0x' || substr(md5('7:' || coalesce(doc_id::varchar, '')), 1, 13))::bigint + 0.5::double) / 4503599627370496::double as u
  from documents),
sources as (
  select source, sum(size)::bigint as source_size, sum((size * 1000000 // (size + 512)) * size)::bigint as tilted from s group by source),
weighed as (
  select *, [5, 2, 1][((row_number() over (order by source nulls last) - 1) % 3 + 1)::int]::bigint as weight, source_size * 2 as cap from sources),
levels as (
  select *, (1.5::double * (sum(source_size) over ())::bigint - coalesce(sum(cap) over o, 0)::bigint)
            / nullif(((sum(weight) over ()) - coalesce(sum(weight) over o, 0))::double, 0) as level
  from weighed window o as (order by cap / weight, source nulls first rows between unbounded preceding and 1 preceding)),
targets as (
  select *, least(cap::double, weight * coalesce((select max(level) from levels), 0)) as target from levels),
f as (
  select *, coalesce(floor(target / nullif(source_size, 0)), 0)::bigint as whole,
         coalesce(target / nullif(source_size, 0) - floor(target / nullif(source_size, 0)), 0) as part from targets),
p as (
  select s.doc_id, s.source, s.size, s.text, u, f.source_size, f.target, f.whole, f.part, f.target - f.whole * f.source_size::double as rest,
         f.part + 0.5::double * least(f.part, 1::double - f.part) *
           ((s.size * 1000000 // (s.size + 512)) / 1000000::double - coalesce(f.tilted::double / nullif(f.source_size, 0), 0) / 1000000::double) as p
  from s join f on s.source is not distinct from f.source),
q as (select *, case when part > 0 then (u / (1::double - u)) / (p / (1::double - p)) end as q from p),
r as (
  select *, sum(size) over (partition by source order by q, doc_id, size rows between unbounded preceding and current row) as total
  from q where q is not null
  union all by name select *, null::hugeint as total from q where q is null)
select doc_id, size, source_size, target,
       ((whole + case when total is not null and (total <= rest or (total - size <= rest and total - rest < rest - (total - size))) then 1 else 0 end) * size)::bigint as taken
from r
"""

# Decontamination: every window of ten words, without fingerprints.
DECONTAMINATION = r"""
with words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws from documents),
items as (
  select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws from benchmark),
sized as (select *, least(len(ws), 10) as n from items where len(ws) > 0),
windows as (
  select distinct item_id, n, ws[i:i + n - 1] as g from (select *, unnest(range(1, len(ws) - n + 2)) as i from sized)),
lengths as (select distinct n from sized),
places as (
  select doc_id, n, i, ws[i:i + n - 1] as g
  from (select doc_id, n, ws, unnest(range(1, len(ws) - n + 2)) as i from words, lengths where len(ws) >= n)),
found as (select doc_id, item_id, p.n, i from places p join windows w on p.n = w.n and p.g = w.g),
hit as (select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(i, i + n)) as p from found) group by doc_id),
per_doc as (
  select doc_id, array_to_string(list_sort(list(distinct item_id::varchar)), ',') as ids, count(distinct item_id) as n_items
  from found group by doc_id)
select w.doc_id, len(ws)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
       sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from words w left join hit using (doc_id) left join per_doc using (doc_id)
"""

# Collocations: all phrases of each length exploded and counted; 128-bit products.
COLLOCATIONS = r"""
with pieces as (
  select lang, row_number() over () as piece,
         regexp_extract_all(p, '[^\x20\x09]+') as ws
  from (select coalesce(lang, 'und') as lang,
               unnest(regexp_split_to_array(
                 translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as p
        from documents)),
leads as (
  select lang, ws[i] as w1, ws[i + 1] as w2, ws[i + 2] as w3
  from (select lang, ws, unnest(range(1, len(ws) + 1)) as i from pieces)),
totals as (select lang, count(*)::bigint as n from leads group by lang),
one as (select lang, w1 as p, count(*)::bigint as f from leads group by all),
two as (select lang, w1, w2, w1 || ' ' || w2 as p, count(*)::bigint as f from leads where w2 is not null group by all),
three as (
  select lang, w1, w2, w3, w1 || ' ' || w2 || ' ' || w3 as p, count(*)::bigint as f
  from leads where w3 is not null group by all having count(*) >= 10),
cuts as (
  select t.lang, t.p, t.f as a, 1 as k, x.f as l, y.f as r
  from two t join one x on x.lang = t.lang and x.p = t.w1 join one y on y.lang = t.lang and y.p = t.w2 where t.f >= 10
  union all
  select t.lang, t.p, t.f, 1, x.f, y.f
  from three t join one x on x.lang = t.lang and x.p = t.w1 join two y on y.lang = t.lang and y.w1 = t.w2 and y.w2 = t.w3
  union all
  select t.lang, t.p, t.f, 2, x.f, y.f
  from three t join two x on x.lang = t.lang and x.w1 = t.w1 and x.w2 = t.w2 join one y on y.lang = t.lang and y.p = t.w3),
scores as (
  select *, (1000000::hugeint * a * a // (l::hugeint * r))::bigint as score from cuts),
lowest as (
  select * from scores qualify row_number() over (partition by lang, p order by score, k) = 1),
inside as (
  select lang, w1 || ' ' || w2 as p, f from three union all select lang, w2 || ' ' || w3, f from three),
held as (select t.lang, t.p from two t join inside i on i.lang = t.lang and i.p = t.p group by t.lang, t.p, t.f having 100 * max(i.f) >= 50 * t.f),
ranked as (
  select *, row_number() over (partition by lang order by score desc, a desc, p) as rank
  from lowest where (lang, p) not in (select (lang, p) from held))
select lang, rank, p as phrase, a, l, r, n, score from ranked join totals using (lang) where rank <= 2000
"""
