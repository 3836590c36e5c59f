"""Queries: projection, mixed-type features, mixtures, repaired and bucketed tables."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from logweave.operators import assemble as A
from logweave.operators import counts as C
from logweave.operators import mixed as X
from logweave.operators import mixtures as G
from logweave.operators import reduce as R
from logweave.operators import tensors as T
from logweave.operators.batches import assign_batches, with_day
from logweave.operators.intervals import interval_features
from logweave.plans import sqlgen as S
from logweave.plans.prep_plans import _IV_SQL
from logweave.plans.registry import query
from logweave.plans.tensor_plans import sec_sql
from logweave.session import cut_lineage
from logweave.sources import sinks as SK
from logweave.sources.fixtures import embedding_rows, ids_events, log_events, tabular_part
from logweave.streaming.incremental import scratch

_CENTRED = """
WITH v AS (SELECT vec_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings),
m AS (SELECT pos, avg(x) AS mean, var_samp(x) AS var FROM v GROUP BY pos)
"""


@query(
    "projection",
    f"{_CENTRED} SELECT vec_id, {S.rnd('sum((x - mean) ** 2)')} AS centred, {S.rnd('sum(x * x)')} AS plain, true AS shorter "
    "FROM v JOIN m USING (pos) GROUP BY vec_id",
)
def projection(spark, d):
    """L3: every embedding projected on all principal components and all right
    singular vectors keeps its length; on the first eight it is shorter."""
    rows = embedding_rows(spark, d).select("vec_id", "embedding")
    dims = len(rows.first().embedding)
    square = lambda c: F.aggregate(c, F.lit(0.0), lambda a, x: a + x * x)
    full = R.dim_reduc(R.dim_reduc(rows, R.PCA(dims), "embedding", "p"), R.TruncatedSVD(dims), "embedding", "s")
    part = R.dim_reduc(full, R.PCA(8), "embedding", "p8")
    return part.select("vec_id", square("p").alias("centred"), square("s").alias("plain"), (square("p8") <= square("p") + 1e-9).alias("shorter"))


@query(
    "projection_variance",
    f"{_CENTRED} SELECT {S.rnd('sum(var)')} AS total, true AS falling, true AS uncorrelated, true AS unit FROM m",
)
def projection_variance(spark, d):
    """L3: the components' variances sum to the total, fall, and are those of the
    projected rows, which don't correlate; components are orthonormal."""
    rows = embedding_rows(spark, d).select("embedding")
    fit = R.PCA(len(rows.first().embedding)).fit(rows, "embedding")
    n, sums, square = R.products(fit.transform(rows, "embedding"), "reduced")
    var = (square / (n - 1)).diagonal()
    falling = all(a >= b - 1e-12 for a, b in zip(fit.variance, fit.variance[1:])) and abs(var - fit.variance).max() < 1e-9
    off = abs(square / (n - 1) - (square / (n - 1)).diagonal() * R.np.eye(len(var))).max() < 1e-9
    unit = abs(fit.components.T @ fit.components - R.np.eye(len(var))).max() < 1e-9
    return spark.createDataFrame([(float(var.sum()), bool(falling), bool(off), bool(unit))], "total double, falling boolean, uncorrelated boolean, unit boolean")


RAW = ["p_brand", "p_size", "p_type", "code"]


def _raw(spark, d):
    """Strings, numbers, numbers as strings, NULLs."""
    code = F.when(F.col("p_partkey") % 13 == 0, None).otherwise((F.col("p_partkey") % 5).cast("string"))
    return tabular_part(spark, d).withColumn("code", code)


_RAW_SQL = """(SELECT p_partkey, CASE WHEN p_partkey % 11 <> 0 THEN p_brand END AS p_brand, p_type,
    CASE WHEN p_partkey % 7 <> 0 THEN p_size END AS p_size, CASE WHEN p_partkey % 13 <> 0 THEN p_partkey % 5 END AS code FROM part)"""


@query(
    "type_probe",
    f"SELECT 'p_brand' AS \"column\", 'levels' AS kind, count(*) > count(p_brand) AS has_null FROM {_RAW_SQL} "
    f"UNION ALL SELECT 'p_size', 'number', count(*) > count(p_size) FROM {_RAW_SQL} "
    f"UNION ALL SELECT 'p_type', 'levels', count(*) > count(p_type) FROM {_RAW_SQL} "
    f"UNION ALL SELECT 'code', 'number', count(*) > count(code) FROM {_RAW_SQL}",
)
def type_probe(spark, d):
    """Which columns of a raw table are numbers, and which have NULLs."""
    found = X.type_probe(_raw(spark, d), RAW)
    return spark.createDataFrame([(c, *v) for c, v in found.items()], "column string, kind string, has_null boolean")


@query(
    "mixed_features",
    f"""
    WITH r AS (SELECT * FROM {_RAW_SQL}), b AS (SELECT min(p_brand) AS brand, min(p_type) AS type FROM r),
    e AS (
        SELECT p_partkey, CASE WHEN p_brand IS NULL THEN 'p_brand_null' WHEN p_brand <> brand THEN 'p_brand_' || p_brand END AS entry, 1.0 AS value FROM r, b
        UNION ALL SELECT p_partkey, 'p_type_' || p_type, 1.0 FROM r, b WHERE p_type <> type
        UNION ALL SELECT p_partkey, CASE WHEN p_size IS NULL THEN 'p_size_null' WHEN p_size <> 0 THEN 'p_size' END, coalesce(p_size, 1) FROM r
        UNION ALL SELECT p_partkey, CASE WHEN code IS NULL THEN 'code_null' WHEN code <> 0 THEN 'code' END, coalesce(code, 1) FROM r)
    SELECT p_partkey, entry, CAST(value AS DOUBLE) AS value FROM e WHERE entry IS NOT NULL
    """,
)
def mixed_features(spark, d):
    """The non-zero entries of the mixed-type vector of every part, by name."""
    found, names = X.mixed_features(_raw(spark, d), RAW)
    named = F.array(*[F.lit(n) for n in names])
    cells = found.select("p_partkey", F.posexplode(vector_to_array("features")).alias("pos", "value")).where("value <> 0")
    return cells.select("p_partkey", F.element_at(named, F.col("pos") + 1).alias("entry"), "value")


@query("mixed_proximity")
def mixed_proximity(spark, d):
    """L4 from a raw table: forest proximity between part types by brand, size and
    code, towards the price."""
    return X.proximity(_raw(spark, d), "p_type", "p_retailprice", ["p_brand", "p_size", "code"])


@query(
    "mixture_kinds",
    "SELECT count(*) AS n, true AS rises, true AS full_is_likeliest, true AS weights, true AS ranks FROM embeddings",
)
def mixture_kinds(spark, d):
    """L1: mixtures of all four kinds on four components of the embeddings: rows
    fitted, whether each likelihood only rises, whether the full covariance is
    the likeliest for one component, whether weights sum to 1 and AIC ranks."""
    rows = cut_lineage(R.dim_reduc(embedding_rows(spark, d), R.PCA(4), "embedding", "features").select("features"))
    models = {(k, kind): G.fit_mixture(rows, k, kind, max_iter=20) for k in (1, 3) for kind in G.KINDS}
    rises = all(b >= a - 1e-6 * abs(a) for m in models.values() for a, b in zip(m.likelihoods, m.likelihoods[1:]))
    one = {kind: models[1, kind].likelihoods[-1] for kind in G.KINDS}
    likeliest = one["full"] >= one["diag"] - 1e-3 >= one["spherical"] - 2e-3 and abs(one["full"] - one["tied"]) < 1e-3
    weights = all(abs(m.weights.sum() - 1) < 1e-9 for m in models.values())
    ranks = all(m.aic == 2 * m.parameters - 2 * m.likelihoods[-1] for m in models.values())
    n = models[1, "full"].n
    return spark.createDataFrame([(n, bool(rises), bool(likeliest), bool(weights), ranks)], "n long, rises boolean, full_is_likeliest boolean, weights boolean, ranks boolean")


@query("sink_repaired_series", f'SELECT s.*, i.split FROM ({sec_sql()}) s JOIN {S.IDS_EVENTS} i USING ("FileID")')
def sink_repaired_series(spark, d):
    """A10: a dump whose every tenth file lost its customers is checked for unhealthy
    files and repaired in place; it reads back whole."""
    whole = cut_lineage(T.split_series(T.per_second_counts(log_events(spark, d)), ids_events(spark, d)))
    lost = F.pmod(F.xxhash64(F.lit("lost"), "FileID"), F.lit(10)) == 0
    broken = whole.withColumns({c: F.when(lost, 0).otherwise(F.col(c)).cast("long") for c in ("CustomerIDCount", "CustomerIDUniqCount")})
    path = scratch(spark, "repaired")
    SK.write_bucketed_series(broken, path)
    SK.repair_series(path, whole, T.health_check(spark.read.parquet(path)))
    return spark.read.parquet(path).drop("bucket")


@query(
    "nuniq_customer_sketch_7",
    f'SELECT batch_id, "FileID", count(DISTINCT "CustomerID") AS n, true AS near FROM {S.batched(S.LOG_EVENTS, 7)} GROUP BY ALL',
)
def nuniq_customer_sketch_7(spark, d):
    """D4 from mergeable daily sketches: 7-day distinct customers, beside the exact
    counts: whether the estimate is within 3 % (or one)."""
    log = with_day(log_events(spark, d))
    guess = C.uniq_from_sketches(C.sketch_facts(log, "uniqCustomer"), 7, "guess")
    exact = C.uniq_facts(assign_batches(log, 7), "uniqCustomer").withColumnRenamed("uniqCustomer", "n")
    return exact.join(guess, ["batch_id", "FileID"], "left").select(
        "batch_id", "FileID", "n", (F.abs(F.col("guess") - F.col("n")) <= F.greatest(F.lit(1.0), 0.03 * F.col("n"))).alias("near")
    )


@query(
    "assemble_bucketed",
    f"""
    WITH i AS ({_IV_SQL}), c AS (SELECT "FileID", count(*) AS events FROM {S.LOG_EVENTS} GROUP BY 1),
    u AS (SELECT "FileID", count(DISTINCT "CustomerID") AS customers FROM {S.LOG_EVENTS} WHERE "ProductID" = 'purchase' GROUP BY 1)
    SELECT "FileID", "QueryTsIntervalMean", "QueryTsIntervalMax", events, customers
    FROM (SELECT "FileID" FROM i UNION SELECT "FileID" FROM c UNION SELECT "FileID" FROM u)
    LEFT JOIN i USING ("FileID") LEFT JOIN c USING ("FileID") LEFT JOIN u USING ("FileID")
    """,
)
def assemble_bucketed(spark, d):
    """C1 over co-bucketed catalog tables: assembled without an exchange."""
    log = log_events(spark, d)
    folder = scratch(spark, "bucketed")
    name = folder.rsplit("-", 1)[-1]
    tables = {
        f"iv_{name}": interval_features(log).select("FileID", "QueryTsIntervalMean", "QueryTsIntervalMax"),
        f"n_{name}": log.groupBy("FileID").agg(F.count(F.lit(1)).alias("events")),
        f"u_{name}": log.where("ProductID = 'purchase'").groupBy("FileID").agg(F.count_distinct("CustomerID").alias("customers")),
    }
    SK.write_co_bucketed(tables, f"keys_{name}", folder, buckets=8)
    return A.assemble_bucketed(spark, f"keys_{name}", list(tables))
