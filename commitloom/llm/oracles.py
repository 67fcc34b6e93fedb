"""DuckDB SQL for the queries that SQL can express over whole tables."""

from __future__ import annotations



def _vector_codes() -> str:
    """Six rounds of assignment and floored means, one after the other, then the last assignment."""
    assigned = """
{name} as (
  select rn, p, struct_extract(nearest, 'e') as e, struct_extract(nearest, 'd') as d from (
    select v.rn, v.p, min(struct_pack(d := list_sum(list_transform(list_zip(v.part, c.entry), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), e := c.e))
      as nearest
    from parts v join {books} c on v.p = c.p group by v.rn, v.p
  )
)"""
    moved = """
{name} as (
  select o.p, o.e, coalesce(n.entry, o.entry) as entry from {books} o left join (
    select p, e, list(cast(((s - ((s % c) + c) % c) // c) as bigint) order by i) as entry from (
      select a.p, a.e, g.i, sum(v.part[g.i]) as s, count(*) as c
      from {codes} a join parts v on a.rn = v.rn and a.p = v.p, generate_series(1, len(v.part)) as g(i)
      group by a.p, a.e, g.i
    ) group by p, e
  ) n on o.p = n.p and o.e = n.e
)"""
    steps = []
    for i in range(6):
        steps.append(assigned.format(name=f"codes{i}", books=f"books{i}"))
        steps.append(moved.format(name=f"books{i + 1}", books=f"books{i}", codes=f"codes{i}"))
    steps.append(assigned.format(name="codes6", books="books6"))
    return """
with kept as materialized (
  select row_number() over (order by vec_id nulls last, embedding) as rn, vec_id, label,
    list_transform(embedding, lambda x: cast(floor(4096 * cast(x as double)) as bigint)) as v
  from embeddings where embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), parts as materialized (
  select rn, p, v[p * len(v) // 8 + 1 : (p + 1) * len(v) // 8] as part from kept, generate_series(0, 7) as g(p)
), books0 as (
  select p, rn - 1 as e, part as entry from parts where rn <= 16
),""" + ",".join(s.replace(" as (", " as materialized (", 1) for s in steps) + """,
coded as (
  select rn, string_agg(lpad(to_hex(e), 2, '0'), '' order by p) as code, cast(sum(d) as bigint) as error
  from codes6 group by rn
), digest as (
  select sha256(string_agg(array_to_string(entry, ','), ',' order by p, e)) as codebooks_sha256 from books6
)
select k.vec_id, lower(c.code) as code, c.error, cast(sum(c.error) over (partition by k.label) as bigint) as label_error,
  codebooks_sha256
from kept k join coded c on k.rn = c.rn, digest
"""


ORACLES: dict[str, str] = {
    "op5_line_dedup": """
with lines as (
  select doc_id, generate_subscripts(l, 1) as pos, unnest(l) as line
  from (select doc_id, string_split(coalesce(text, ''), chr(10)) as l from documents)
), keyed as (
  select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from lines
), shared as (
  select key, min(doc_id) as first from keyed where length(key) >= 10
  group by key having count(distinct doc_id) >= 2
), marked as (
  select k.*, coalesce(k.doc_id <> s.first, false) as dropped from keyed k left join shared s on k.key = s.key
)
select doc_id, count(*) as n_lines, count(*) filter (where dropped) as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not dropped), '')) as kept_sha256
from marked group by doc_id
""",
    "op6_substring_dedup": r"""
with words as (
  select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents
), windows as (
  select doc_id, pos, md5(array_to_string(list_slice(w, pos, pos + 49), ' ')) as h
  from words, generate_series(1, len(w) - 49) as g(pos)
), repeated as (
  select w.doc_id, w.pos from windows w join (select h, min(doc_id) as first from windows group by h) f
  on w.h = f.h and w.doc_id > f.first
), gone as (
  select distinct doc_id, pos + k as pos from repeated, generate_series(0, 49) as g(k)
), flat as (
  select doc_id, generate_subscripts(w, 1) as pos, unnest(w) as word from words
)
select d.doc_id, len(d.w) as n_words, coalesce(n.n_removed, 0) as n_removed, sha256(coalesce(n.kept, '')) as kept_sha256
from words d left join (
  select f.doc_id, count(g.pos) as n_removed, string_agg(f.word, ' ' order by f.pos) filter (where g.pos is null) as kept
  from flat f left join gone g on f.doc_id = g.doc_id and f.pos = g.pos group by f.doc_id
) n on d.doc_id = n.doc_id
""",
    "op10_decontaminate": r"""
with lower_documents as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents
), items as (
  select cast(item_id as varchar) as item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark
), benchmark_windows as (
  select distinct item, least(13, len(w)) as size, array_to_string(list_slice(w, pos, pos + least(13, len(w)) - 1), ' ') as t
  from items, generate_series(1, len(w) - least(13, len(w)) + 1) as g(pos) where len(w) > 0
), sizes as (select distinct size from benchmark_windows),
windows as (
  select doc_id, size, pos, array_to_string(list_slice(w, pos, pos + size - 1), ' ') as t
  from lower_documents, sizes, generate_series(1, len(w) - size + 1) as g(pos)
), hits as (
  select w.doc_id, w.pos, w.size, b.item from windows w join benchmark_windows b on w.t = b.t and w.size = b.size
), covered as (
  select doc_id, count(distinct pos + k) as n_hit from hits, generate_series(0, size - 1) as g(k) group by doc_id
), found as (
  select doc_id, count(distinct item) as n_items, string_agg(distinct item, ',' order by item) as listed
  from hits group by doc_id
)
select d.doc_id, len(d.w) as n_words, coalesce(c.n_hit, 0) as n_hit, coalesce(f.n_items, 0) as n_items,
  sha256(coalesce(f.listed, '')) as items_sha256,
  coalesce(c.n_hit > 0 and 20 * c.n_hit >= len(d.w), false) as contaminated
from lower_documents d left join covered c on d.doc_id = c.doc_id left join found f on d.doc_id = f.doc_id
""",
    "op12_vector_codes": _vector_codes(),
    "op13_phrase_collocations": r"""
with pieces as (
  select row_number() over () as piece, lang, regexp_extract_all(text, '[^\x20\x09]+') as w from (
    select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as text from documents
  )
), totals as (select lang, sum(len(w)) as n from pieces group by lang),
phrases as materialized (
  select lang, w, len(w) as size, count(*) as a from (
    select lang, list_slice(w, i, i + size - 1) as w
    from pieces, generate_series(1, 5) as s(size), generate_series(1, len(w) - size + 1) as g(i)
  ) group by lang, w having count(*) >= 100
), scored as (
  select p.lang, p.w, p.size, p.a, k, l.a as l, r.a as r, t.n,
    (1000 * cast(p.a as hugeint) * cast(t.n as hugeint)) // (cast(l.a as hugeint) * cast(r.a as hugeint)) as score
  from phrases p cross join generate_series(1, 4) as g(k)
  join phrases l on l.lang = p.lang and l.w = list_slice(p.w, 1, k)
  join phrases r on r.lang = p.lang and r.w = list_slice(p.w, k + 1, p.size)
  join totals t on t.lang = p.lang where k < p.size
), weakest as (
  select * from scored qualify row_number() over (partition by lang, w order by score, k) = 1
), inner_phrases as (
  select q.lang, list_slice(q.w, i, i + m - 1) as w, max(q.a) as longer
  from phrases q, generate_series(2, 4) as s(m), generate_series(1, q.size - m + 1) as g(i)
  where m < q.size group by 1, 2
), ranked as (
  select c.*, array_to_string(c.w, ' ') as phrase from weakest c left join inner_phrases i on c.lang = i.lang and c.w = i.w
  where i.longer is null or i.longer < c.a
)
select lang, rank, phrase, a, cast(l as bigint) as l, cast(r as bigint) as r, cast(n as bigint) as n,
  cast(score as bigint) as score
from (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from ranked)
where rank <= 2000
""",
}
