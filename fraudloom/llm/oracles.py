"""DuckDB SQL for the queries that SQL can express on whole tables."""

from __future__ import annotations

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

# Cosine in double precision over all pairs, then smallest reachable ids.
_OP2 = """
with recursive v as (
  select vec_id, embedding::double[] as e from embeddings
  where embedding is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0),
links as materialized (
  select a.vec_id as a, b.vec_id as b from v a join v b on a.vec_id <> b.vec_id
  where len(a.e) = len(b.e) and list_cosine_similarity(a.e, b.e) >= 0.95),
reach(vec_id, to_id) as (
  select vec_id, vec_id from embeddings
  union
  select r.vec_id, l.b from reach r join links l on l.a = r.to_id),
smallest as (select vec_id, min(to_id) as component_id from reach group by vec_id),
counted as (select a as vec_id, count(*) as n from links group by a)
select e.vec_id, coalesce(c.n, 0)::bigint as n_links, s.component_id, e.vec_id = s.component_id as kept
from embeddings e join smallest s using (vec_id) left join counted c using (vec_id)
"""

_OP4 = r"""
with cut as (select doc_id, string_split(coalesce(text, ''), chr(10)) as ls from documents),
lines as (select doc_id, unnest(ls) as line, unnest(range(len(ls))) as pos from cut),
keyed as (
  select *, translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from lines),
firsts as (select key, min(doc_id) as first_id from keyed where length(key) >= 10 group by key),
judged as (
  select k.doc_id, k.pos, k.line, coalesce(f.first_id < k.doc_id, false) as gone
  from keyed k left join firsts f using (key))
select doc_id, count(*)::bigint as n_lines, count(*) filter (gone)::bigint as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by pos) filter (not gone), '')) as kept_sha256
from judged group by doc_id
"""

_OP9 = r"""
with d as (
  select doc_id, coalesce(text, '') as t, """ + _WORDS + r""" as w from documents),
windows as (
  select doc_id, unnest(range(1, len(w) - 1)) as i, w from d where len(w) >= 3),
named as (select doc_id, i, w[i:i + 2] as shingle from windows),
often as (
  select doc_id, i from named qualify count(*) over (partition by doc_id, shingle) > 1),
covered as (
  select doc_id, count(distinct i + k) as n from often, range(3) as r(k) group by doc_id),
lines as (select doc_id, unnest(string_split(t, chr(10))) as line from d),
worded as (select doc_id, line from lines where regexp_matches(line, '[^\x20\x09-\x0D]')),
dups as (select doc_id, count(*) as n, count(*) - count(distinct line) as dup from worded group by doc_id),
m as (
  select d.doc_id, len(w)::bigint as n_words,
    length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::bigint as word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::bigint as n_symbols,
    coalesce(dups.dup, 0)::bigint as n_dup_lines, coalesce(covered.n, 0)::bigint as n_repeat_words,
    coalesce(dups.n, 0) as n_lines,
    length(regexp_replace(t, '[^A-Z]+', '', 'g')) as upper_n, length(regexp_replace(t, '[^a-z]+', '', 'g')) as lower_n,
    length(regexp_replace(t, '[^.!?]+', '', 'g')) as stops
  from d left join dups using (doc_id) left join covered using (doc_id)),
j as (
  select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
    100 * n_symbols > 30 * n_words or 100 * n_dup_lines > 60 * n_lines or 100 * upper_n > 50 * (upper_n + lower_n)
    or stops > n_words or word_chars > 40 * n_words or word_chars < 2 * n_words as rejected
  from m)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not (base_failed or rejected) as kept
from j
"""

_USABLE = """embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0"""

_OP11 = f"""
with t as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: floor(256 * x::double)) as v
  from embeddings where label is not null and {_USABLE}),
s as (
  select a.vec_id as anchor_id, b.vec_id, a.label = b.label as same, list_dot_product(a.v, b.v)::bigint as score
  from t a join t b on a.vec_id <> b.vec_id where a.vec_id % 100 = 0),
p as (
  select anchor_id, vec_id as positive_id, score as positive_score from s where same
  qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5),
n as (
  select p.anchor_id, positive_id, s.vec_id as negative_id, positive_score, s.score as negative_score,
    row_number() over (partition by p.anchor_id, positive_id order by s.score desc, s.vec_id)::int as rank
  from p join s on s.anchor_id = p.anchor_id and not s.same
    and 30 * positive_score <= 100 * s.score and 100 * s.score <= 90 * positive_score)
select * from n where rank <= 10
"""


def _op13(rounds: int = 6) -> str:
    """Rounds of assignment and averaging, each a pair of common table expressions."""
    def assigned(n: int) -> str:
        return f"""a{n} as materialized (
  select p.vec_id, p.part, p.x, c.entry,
    (list_dot_product(p.x, p.x) - 2 * list_dot_product(p.x, c.c) + list_dot_product(c.c, c.c))::bigint as error
  from p join c{n} c using (part)
  qualify row_number() over (partition by p.vec_id, p.part order by error, c.entry) = 1)"""

    def averaged(n: int) -> str:
        return f"""c{n + 1} as materialized (
  select c.part, c.entry, coalesce(m.c, c.c) as c from c{n} c left join (
    select part, entry, list(mean order by place) as c from (
      select part, entry, place, floor(sum(value) / count(*)) as mean
      from (select part, entry, unnest(x) as value, unnest(range(len(x))) as place from a{n}) group by all)
    group by all) m using (part, entry))"""

    steps = [f"{assigned(n)},\n{averaged(n)}" for n in range(rounds)] + [assigned(rounds)]
    return f"""
with k as (
  select vec_id, label, list_transform(embedding, lambda x: floor(4096 * x::double)) as v
  from embeddings where {_USABLE}),
p as materialized (
  select vec_id, i as part, v[i * len(v) // 8 + 1:(i + 1) * len(v) // 8] as x from k, range(8) as r(i)),
c0 as (
  select part, x as c, row_number() over (partition by part order by vec_id) - 1 as entry from p qualify entry < 16),
{", ".join(steps)},
coded as (
  select vec_id, string_agg(printf('%02x', entry), '' order by part) as code, sum(error)::bigint as error
  from a{rounds} group by vec_id),
books as (
  select sha256(string_agg(value::bigint::varchar, ',' order by part, entry, place)) as codebooks_sha256
  from (select part, entry, unnest(c) as value, unnest(range(len(c))) as place from c{rounds}))
select vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error, codebooks_sha256
from coded join k using (vec_id), books
"""


SQL: dict[str, str] = {
    "op2_embedding_near_dedup": _OP2,
    "op4_line_dedup": _OP4,
    "op9_quality_rules": _OP9,
    "op11_hard_negatives": _OP11,
    "op13_vector_codes": _op13(),
}
