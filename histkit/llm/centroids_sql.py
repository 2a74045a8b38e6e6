"""DuckDB SQL for the rows of ``op12_centroids``: every vector against every centroid, component by component."""

from __future__ import annotations


def _round(k: int) -> str:
    return f"""
near{k} as (
  select uid, c, d from (
    select uid, c, d, row_number() over (partition by uid order by d, c) as place
    from (select p.uid, q.c, sum((p.x - q.x) * (p.x - q.x)) as d from parts p join centre{k} q on p.dim = q.dim group by p.uid, q.c)
  ) where place = 1),"""


def _move(k: int) -> str:
    return f"""
mean{k} as (
  select n.c, p.dim, sum(p.x)::hugeint as total, count(*)::hugeint as n from near{k} n join parts p on n.uid = p.uid group by n.c, p.dim),
centre{k + 1} as (
  select q.c, q.dim, cast(coalesce((m.total - ((m.total % m.n) + m.n) % m.n) / m.n, q.x) as bigint) as x
  from centre{k} q left join mean{k} m on m.c = q.c and m.dim = q.dim),"""


def oracle(clusters: int = 16, rounds: int = 3, dims: int = 64, scale: int = 64, seed: str = "1") -> str:
    steps = "".join(_round(k) + _move(k) for k in range(rounds)) + _round(rounds)
    return f"""
with rows as (select row_number() over () as uid, vec_id, embedding from embeddings where len(embedding) = {dims}),
wide as (select uid, vec_id, unnest(embedding)::double as x, unnest(range(1, {dims + 1})) as dim from rows),
bad as (select distinct uid from wide where x is null or not isfinite(x)),
parts as (select uid, vec_id, dim, cast(floor({scale} * x) as bigint) as x from wide where uid not in (select uid from bad)),
ranked as (
  select uid, row_number() over (order by sha256('{seed}:' || vec_id), uid) - 1 as c from (select distinct uid, vec_id from parts)),
centre0 as (select c, dim, x from ranked join parts using (uid) where c < {clusters}),{steps}
names as (select c, sha256(string_agg(x::varchar, ',' order by dim)) as centroid_sha256 from centre{rounds} group by c),
inner_sums as (select c, sum(d) as cluster_inertia from near{rounds} group by c)
select r.vec_id, n.c::int as cluster, n.d::bigint as distance, i.cluster_inertia::bigint as cluster_inertia,
  (select sum(d) from near{rounds})::bigint as inertia, m.centroid_sha256
from near{rounds} n join rows r using (uid) join inner_sums i using (c) join names m using (c)
"""
