"""Queries: stratified splits, exact nearest neighbours, oversampling."""

from __future__ import annotations

from pyspark.sql import functions as F

from logweave.operators import neighbors as N
from logweave.operators.ranks import stratified_split as split
from logweave.plans import sqlgen as S
from logweave.plans.registry import query
from logweave.sources.fixtures import embedding_rows, ids_events

_SPLIT_SQL = f"""
WITH s AS (SELECT y, count(*) AS n FROM {S.IDS_EVENTS} GROUP BY y),
q AS (SELECT y, n * 33 // 100 + CAST(row_number() OVER (ORDER BY n * 33 % 100 DESC, y)
    <= ceil(sum(n) OVER () * 33 / 100.0) - sum(n * 33 // 100) OVER () AS INTEGER) AS quota FROM s),
r AS (SELECT "FileID", y, k, row_number() OVER (
    PARTITION BY k, y ORDER BY md5(CAST(42 + k AS VARCHAR) || ':' || "FileID"), "FileID") AS place
    FROM {S.IDS_EVENTS}, range(0, 3) t(k))
SELECT "FileID", r.y, CAST(k AS INTEGER) AS split_no, CASE WHEN place <= quota THEN 'test' ELSE 'train' END AS subset
FROM r JOIN q ON r.y = q.y
"""


@query("stratified_split", _SPLIT_SQL)
def stratified_split(spark, d):
    """M5 with strata: three splits with a third of every class held out, to one row."""
    return split(ids_events(spark, d).select("FileID", "y"), "FileID", "y", 33, 42, n_splits=3)


def _near_sql(source: str, k: int) -> str:
    return f"""
    SELECT a.id, b.id AS neighbor, list_distance(a.v, b.v) AS distance,
        row_number() OVER (PARTITION BY a.id ORDER BY list_distance(a.v, b.v), b.id) AS rank
    FROM {source} a JOIN {source} b ON a.id <> b.id QUALIFY rank <= {k}
    """


@query(
    "nearest_neighbors",
    f"""
    WITH v AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)
    SELECT id AS vec_id, CAST(rank AS INTEGER) AS rank, neighbor, {S.rnd("distance")} AS distance FROM ({_near_sql("v", 5)})
    """,
)
def nearest_neighbors(spark, d):
    """The five exact nearest neighbours of every embedding."""
    return N.nearest(embedding_rows(spark, d), 5, "vec_id", "embedding")


_SMOTE_SQL = f"""
WITH v AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE label < 3),
c AS (SELECT count(*) FILTER (label < 3) AS n, count(*) FILTER (label >= 3) - count(*) FILTER (label < 3) AS lacks FROM embeddings),
r AS (SELECT id, v, row_number() OVER (ORDER BY md5('42:' || id), id) - 1 AS rank FROM v),
drawn AS (SELECT id, v, unnest(range(1, lacks // n + CAST(rank < lacks % n AS INTEGER) + 1)) AS sample, least(5, n - 1) AS k FROM r, c),
h AS (SELECT *, md5('42:' || sample || ':' || id) AS h FROM drawn),
p AS (SELECT id, v, sample, ('0x' || substr(h, 9, 8))::BIGINT % k + 1 AS rank, ('0x' || substr(h, 1, 8))::BIGINT / 4294967296.0 AS gap FROM h),
near AS ({_near_sql("v", 5)})
SELECT p.id AS vec_id, CAST(p.sample AS INTEGER) AS sample, near.neighbor, {S.rnd("gap")} AS gap,
    {S.rnd("list_sum(list_transform(list_zip(p.v, w.v), lambda z: z[1] + gap * (z[2] - z[1])))")} AS total,
    {S.rnd("sqrt(list_sum(list_transform(list_zip(p.v, w.v), lambda z: (z[1] + gap * (z[2] - z[1])) ** 2)))")} AS norm
FROM p JOIN near ON near.id = p.id AND near.rank = p.rank JOIN v w ON w.id = near.neighbor
"""


@query("smote", _SMOTE_SQL)
def smote(spark, d):
    """M7: synthetic minority rows (y = 1), each between a row and one of its five
    nearest neighbours; their vectors as sum and norm."""
    made = N.smote(embedding_rows(spark, d), "vec_id", "embedding", "y")
    total = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x)
    norm = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x * x))
    return made.select("vec_id", "sample", "neighbor", "gap", total.alias("total"), norm.alias("norm"))


@query("smote_classes", "SELECT y, max(n) OVER () AS n FROM (SELECT CAST(label < 3 AS INTEGER) AS y, count(*) AS n FROM embeddings GROUP BY 1)")
def smote_classes(spark, d):
    """M7: after oversampling both classes have as many rows."""
    rows = embedding_rows(spark, d)
    both = rows.select("y").unionByName(N.smote(rows, "vec_id", "embedding", "y").select(F.lit(1).alias("y")))
    return both.groupBy("y").agg(F.count(F.lit(1)).alias("n"))
