"""DuckDB SQL of the operators that SQL can express."""

from __future__ import annotations

WORD = r"[^\x20\x09-\x0D]+"

#: Whole 200-byte strings are compared by their hexadecimal text; islands of windows that touch are the removed runs.
SUFFIX_DEDUP = """
with d as (select doc_id, hex(encode(coalesce(text, ''))) as x from documents),
w as (select doc_id, s, md5(substr(x, 2 * s + 1, 400)) as m from (select doc_id, x, unnest(range(len(x) // 2 - 199)) as s from d where len(x) >= 400)),
r as (select doc_id, s from (select doc_id, s, count(*) over (partition by m) as c from w) where c > 1),
i as (select doc_id, s, sum(case when s <= p + 200 then 0 else 1 end) over (partition by doc_id order by s) as g
      from (select doc_id, s, lag(s) over (partition by doc_id order by s) as p from r)),
spans as (select doc_id, min(s) as a, max(s) + 200 as b from i group by doc_id, g),
pieces as (select doc_id, coalesce(lag(b) over (partition by doc_id order by a), 0) as f, a as t from spans
           union all select doc_id, coalesce(max(b), 0), any_value(len(x)) // 2 from d left join spans using (doc_id) group by doc_id),
kept as (select doc_id, string_agg(substr(x, 2 * f + 1, 2 * (t - f)), '' order by f) as k from pieces join d using (doc_id) group by doc_id)
select doc_id, cast(len(x) // 2 as bigint) as n_bytes, cast((len(x) - len(k)) // 2 as bigint) as n_removed,
       coalesce(n, 0) as n_spans, sha256(unhex(k)) as kept_sha256
from d join kept using (doc_id) left join (select doc_id, count(*) as n from spans group by doc_id) using (doc_id)
"""

REPEATED_PASSAGES = f"""
with d as (select doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') as w from documents),
win as (select doc_id, s, md5(array_to_string(w[s + 1 : s + 20], ' ')) as m from (select doc_id, w, unnest(range(len(w) - 19)) as s from d where len(w) >= 20)),
r as (select doc_id, s as i from (select doc_id, s, row_number() over (partition by m order by doc_id, s) as k from win) where k > 1),
words as (select doc_id, unnest(w) as word, generate_subscripts(w, 1) - 1 as i from d),
marked as (select doc_id, word, words.i, max(r.i) over (partition by doc_id order by words.i) > words.i - 20 as gone from words left join r using (doc_id, i))
select d.doc_id, len(any_value(w)) as n_words, count(*) filter (gone) as n_removed,
       sha256(coalesce(string_agg(word, ' ' order by i) filter (gone is not true), '')) as kept_sha256
from d left join marked using (doc_id) group by d.doc_id
"""

QUALITY_RULES = f"""
with d as (select doc_id, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '{WORD}') as w from documents),
grams as (select doc_id, s as i, array_to_string(w[s + 1 : s + 5], ' ') as g from (select doc_id, w, unnest(range(len(w) - 4)) as s from d where len(w) >= 5)),
r as (select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, g) as c from grams) where c > 1),
words as (select doc_id, unnest(w) as word, generate_subscripts(w, 1) - 1 as i from d),
marked as (select doc_id, word, words.i, max(r.i) over (partition by doc_id order by words.i) > words.i - 5 as again from words left join r using (doc_id, i)),
counted as (select doc_id, sum(length(word)) as word_chars, count(*) filter (again) as n_repeat_words from marked group by doc_id),
lines as (select doc_id, count(l) as n_lines, count(l) - count(distinct l) as n_dup_lines
          from (select doc_id, unnest(string_split(t, chr(10))) as l from d) where regexp_matches(l, '{WORD}') group by doc_id),
m as (select doc_id, len(w) as n_words, cast(coalesce(word_chars, 0) as bigint) as word_chars, len(regexp_extract_all(t, '[#*$%&|<>]')) as n_symbols,
             coalesce(n_dup_lines, 0) as n_dup_lines, coalesce(n_repeat_words, 0) as n_repeat_words, coalesce(n_lines, 0) as n_lines, len(regexp_extract_all(t, '[0-9]')) as n_digits
      from d left join counted using (doc_id) left join lines using (doc_id)),
f as (select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed from m)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not (base_failed or 10 * n_symbols > 3 * n_words or 10 * n_dup_lines > 3 * n_lines or word_chars < 2 * n_words or word_chars > 25 * n_words or 2 * n_digits > word_chars) as kept
from f
"""

#: The checksum is worked out bit by bit; -1 stands for a shift. Trees grow level by level; a proof's steps are side and sibling.
MERKLE_MANIFEST = """
with recursive sums as (
  select *, xor(list_reduce(list_prepend(cast(4294967295 as bigint), flatten(list_transform(range(1, length(cast(doc_id as varchar)) + 1),
       lambda k: [cast(ascii(substr(cast(doc_id as varchar), k, 1)) as bigint), -1, -1, -1, -1, -1, -1, -1, -1]))),
       lambda c, x: case when x >= 0 then xor(c, x) else xor(c >> 1, 3988292384 * (c & 1)) end), 4294967295) % 7 = 0 as tampered,
    coalesce(strlen(cast(doc_id as varchar)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') as head,
    coalesce(strlen(text) || ':' || text, '-') as tail
  from documents),
leaves as (select *, row_number() over (partition by g order by doc_id nulls first, leaf) - 1 as i from (
  select doc_id, coalesce('=' || lang, '') as g, sha256(head || coalesce(strlen(cast(n_chars as varchar)) || ':' || n_chars, '-') || tail) as leaf,
    sha256(head || coalesce(strlen(cast(m as varchar)) || ':' || m, '-') || tail) as presented
  from (select *, n_chars + case when tampered then 1 else 0 end as m from sums))),
tree as (
  select 0 as l, g, i, leaf as h from leaves
  union all
  select l + 1, g, i // 2, sha256(string_agg(h, '' order by i)) from (select *, count(*) over (partition by g) as c from tree) where c > 1 group by l, g, i // 2),
subroots as (select g, row_number() over (order by g) - 1 as i, h from (select g, arg_max(h, l) as h from tree group by g)),
top as (
  select 0 as l, i, h from subroots
  union all
  select l + 1, i // 2, sha256(string_agg(h, '' order by i)) from (select *, count(*) over () as c from top) where c > 1 group by l, i // 2),
above as (select a.g, list(case when s.h is null then '-' when (a.i >> t.l) % 2 = 1 then 'L' || s.h else 'R' || s.h end order by t.l) as way
  from subroots a cross join (select distinct l from top where l < (select max(l) from top)) t left join top s on s.l = t.l and s.i = xor(a.i >> t.l, 1) group by a.g),
below as (select a.g, a.i, list(case when s.h is null then '-' when (a.i >> t.l) % 2 = 1 then 'L' || s.h else 'R' || s.h end order by t.l) as way
  from leaves a join (select distinct g, l from tree) t using (g)
  join (select g, max(l) as m from tree group by g) using (g)
  left join tree s on s.g = a.g and s.l = t.l and s.i = xor(a.i >> t.l, 1) where t.l < m group by a.g, a.i),
proofs as (select a.*, s.h as subroot, (select arg_max(h, l) from top) as root, coalesce(b.way, []) || coalesce(u.way, []) as way
  from leaves a join subroots s using (g) left join below b on b.g = a.g and b.i = a.i left join above u on u.g = a.g),
folded as (select *, list_reduce(list_prepend(presented, way), lambda acc, x: sha256(case x[1] when 'L' then x[2:] || acc when 'R' then acc || x[2:] else acc end)) as folded_root from proofs)
select doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(way, lambda x: x[2:]), '')) as proof_sha256, folded_root, folded_root = root as verified
from folded
"""

FILTER_AUDIT = f"""
with recursive orders as (
  select '' as o union all select o || f from orders, (select unnest(['A', 'B', 'C', 'D', 'E']) as f) where position(f in o) = 0),
d as (select doc_id, coalesce(lang, '') as part, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '{WORD}') as w from documents),
firsts as (select t, min(doc_id) as first from d group by t),
said as (select doc_id, bool_or(quality = 1) as good, bool_or(toxic = 1) as toxic from labels where doc_id is not null group by doc_id),
flags as (select part, coalesce(good, false) as good, coalesce(toxic, false) as toxic,
    map(['A', 'B', 'C', 'D', 'E'], [len(w) < 200, 100 * len(list_distinct(w)) < 50 * len(w), 100 * len(regexp_extract_all(t, '[A-Z]')) > 3 * length(t),
      regexp_matches(t, '[#$%&*|]'), coalesce(d.doc_id > first, false)]) as f
  from d join firsts using (t) left join said using (doc_id)),
steps as (select part, o as filter_order, cast(k as int) as step, f[o[k]] as fails, good, toxic,
    len(list_filter(range(1, k), lambda j: f[o[j]])) > 0 as earlier, len(list_filter(map_values(f), lambda x: x)) = 1 as once
  from flags, orders, (select unnest(range(1, 6)) as k) where length(o) = 5),
counts as (select part, filter_order, step, count(*) filter (not earlier and not fails) as kept, count(*) filter (not earlier and fails) as removed,
    count(*) filter (earlier and fails) as redundant, count(*) filter (fails and once) as unique_fails,
    count(*) filter (not earlier and fails and good) as good_lost, count(*) filter (not earlier and fails and toxic) as toxic_lost
  from steps group by all)
select *, cast(sum(removed) over (partition by part, filter_order[step]) as bigint) as shapley from counts
"""

SQL = {
    "op4_suffix_dedup": SUFFIX_DEDUP,
    "op7_quality_rules": QUALITY_RULES,
    "op9_repeated_passages": REPEATED_PASSAGES,
    "op12_merkle_manifest": MERKLE_MANIFEST,
    "op13_filter_audit": FILTER_AUDIT,
}
