"""Query ``op11_centroid_clusters``: 40 centroids over whole 64-component vectors, five rounds."""

from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from credlake.llm.centroids import cluster
from credlake.llm.common import table

DIMS, K, ROUNDS, SCALE, SEED = 64, 40, 5, 256, "2"
COLUMNS = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"


def op11_centroid_clusters(spark, sf_dir):
    found = cluster(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", DIMS, K, ROUNDS, SCALE, SEED)
    sums = {r.cluster: int(r.inertia) for r in found.assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("inertia")).collect()}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in found.centroids]
    facts = spark.createDataFrame([(i, s, sum(sums.values()), digest[i]) for i, s in sums.items()], COLUMNS)
    # One row for each of at most K clusters.
    return found.assigned.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _round(i: int) -> str:
    return f"""
d{i} as materialized (select v.rid, c.cluster, sum((v.x - c.x) * (v.x - c.x)) as distance from v join c{i} c using (dim) group by all),
a{i} as materialized (select rid, arg_min(cluster, distance * 1000 + cluster) as cluster, min(distance) as distance from d{i} group by rid)"""


ORACLE = f"""
with e as materialized (
  select row_number() over () as rid, vec_id, embedding, sha256('{SEED}:' || coalesce(vec_id::varchar, '')) as mark from embeddings
  where len(embedding) = {DIMS} and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
v as materialized (select rid, unnest(range({DIMS})) as dim, floor({SCALE} * unnest(embedding)::double)::bigint as x from e),
s as (select rid, row_number() over (order by mark, embedding) - 1 as cluster from e qualify cluster < {K}),
c0 as materialized (select cluster, dim, x from s join v using (rid)),
{",".join(_round(i) + f''',
m{i} as (select a.cluster, v.dim, sum(v.x) as total, count(*) as n from a{i} a join v using (rid) group by all),
c{i + 1} as materialized (select c.cluster, dim, case when m.n is null then c.x
  else (m.total - (((m.total % m.n) + m.n) % m.n)) // m.n end::bigint as x from c{i} c left join m{i} m using (cluster, dim))''' for i in range(ROUNDS))},
{_round(ROUNDS)},
h as (select cluster, sha256(string_agg(x::varchar, ',' order by dim)) as centroid_sha256 from c{ROUNDS} group by cluster)
select e.vec_id, a.cluster::int as cluster, a.distance::bigint as distance,
  (sum(a.distance) over (partition by a.cluster))::bigint as cluster_inertia, (sum(a.distance) over ())::bigint as inertia, h.centroid_sha256
from a{ROUNDS} a join e using (rid) join h using (cluster)
"""
