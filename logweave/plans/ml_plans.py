"""Queries: clustering, PCA, proximity, k-medoids, classifiers.

Model queries are rows-only checks (no SQL form); the k-medoids assignment
step and label distances have DuckDB oracles.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import PCA
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from logweave.operators import cluster as CL
from logweave.operators import models as MD
from logweave.operators.intervals import interval_features
from logweave.operators.prep import fill_policy
from logweave.plans import sqlgen as S
from logweave.plans.registry import query
from logweave.session import cut_lineage
from logweave.sources.fixtures import embedding_rows, ids_events, log_events
from logweave.streaming.incremental import scratch

MEDOIDS = [0, 1, 2]


def _vectors(spark, d):
    return CL.as_vector(embedding_rows(spark, d), "embedding")


def _reduced(spark, d, k=4):
    v = CL.standardize_vector(_vectors(spark, d))
    return PCA(k=k, inputCol="scaled", outputCol="pc").fit(v).transform(v)


@query("gmm_select")
def gmm_select(spark, d):
    """L1: AIC of full-covariance GMMs, k = 2..4, on 4 principal components."""
    table, _ = CL.gmm_select(_reduced(spark, d), [2, 3, 4], features="pc")
    return table


@query("gmm_assign")
def gmm_assign(spark, d):
    """L2: cluster and membership probabilities from the minimum-AIC GMM."""
    df = _reduced(spark, d)
    _, best = CL.gmm_select(df, [2, 3, 4], features="pc")
    return best.transform(df).select("vec_id", "prediction", vector_to_array("probability").alias("probability"))


@query("pca_spectrum")
def pca_spectrum(spark, d):
    """L3: explained variance of 10 principal axes of standardised embeddings."""
    return CL.pca_spectrum(CL.standardize_vector(_vectors(spark, d)), 10)


@query("rf_proximity")
def rf_proximity(spark, d):
    """L4: random-forest proximity distance between embedding labels."""
    return CL.rf_proximity(_vectors(spark, d).withColumn("yd", F.col("y").cast("double")), "label", "yd")


TREES = 4


@query(
    "leaf_distances",
    f"""
WITH v AS (SELECT vec_id, label, unnest(embedding) AS v, generate_subscripts(embedding, 1) - 1 AS tree FROM embeddings),
l AS (SELECT label AS lab, tree, floor(v * 4) AS leaf FROM v WHERE tree < {TREES}),
c AS (SELECT lab, tree, leaf, count(*) AS c FROM l GROUP BY ALL),
n AS (SELECT label AS lab, count(*) AS n FROM embeddings GROUP BY ALL),
s AS (SELECT x.lab AS a, y.lab AS b, sum(x.c * y.c) AS s FROM c x JOIN c y USING (tree, leaf) GROUP BY ALL)
SELECT p.lab AS a, r.lab AS b,
    round(1 - CASE WHEN p.lab = r.lab THEN (s + {TREES} * p.n) / 2 ELSE coalesce(s, 0) END / ({TREES} * p.n * r.n), 6) AS distance
FROM n p CROSS JOIN n r LEFT JOIN s ON s.a = p.lab AND s.b = r.lab
""",
)
def leaf_distances(spark, d):
    """L4, the relational part, on leaves cut from the first dimensions."""
    rows = embedding_rows(spark, d)
    leaves = rows.select(F.col("label").alias("lab"), F.posexplode(F.slice("embedding", 1, TREES)).alias("tree", "v"))
    return CL.leaf_distances(leaves.select("lab", "tree", F.floor(F.col("v").cast("double") * 4).alias("leaf")), TREES)


DIST_SQL = """
WITH e AS (SELECT label, unnest(embedding) AS v, generate_subscripts(embedding, 1) AS pos FROM embeddings),
m AS (SELECT label, pos, avg(v) AS m FROM e GROUP BY ALL)
SELECT a.label AS i, b.label AS j, sqrt(sum((a.m - b.m) * (a.m - b.m))) AS d
FROM m a JOIN m b ON a.pos = b.pos GROUP BY ALL
"""


@query(
    "leaf_pairs",
    """
    WITH v AS (SELECT vec_id, unnest(embedding) AS v, generate_subscripts(embedding, 1) - 1 AS tree FROM embeddings),
    t AS (SELECT count(DISTINCT tree) AS trees FROM v),
    l AS (SELECT vec_id // 5 AS lab, tree, floor(v * 4) AS leaf FROM v),
    c AS (SELECT lab, tree, leaf, count(*) AS c FROM l GROUP BY ALL),
    n AS (SELECT vec_id // 5 AS lab, count(*) AS n FROM embeddings GROUP BY ALL),
    s AS (SELECT x.lab AS a, y.lab AS b, sum(x.c * y.c) AS s FROM c x JOIN c y USING (tree, leaf) GROUP BY ALL)
    SELECT a, b, round(1 - CASE WHEN a = b THEN (s + trees * p.n) / 2 ELSE s END / (trees * p.n * r.n), 6) AS distance
    FROM s JOIN n p ON p.lab = a JOIN n r ON r.lab = b, t
    """,
)
def leaf_pairs(spark, d):
    """L4/C9 for any number of labels (groups of five vectors), on leaves cut from all
    dimensions: the pairs of labels that share a leaf."""
    rows = embedding_rows(spark, d)
    trees = len(rows.first().embedding)
    leaves = rows.select(F.floor(F.col("vec_id") / 5).alias("lab"), F.posexplode("embedding").alias("tree", "v"))
    return CL.leaf_pairs(leaves.select("lab", "tree", F.floor(F.col("v").cast("double") * 4).alias("leaf")), trees)


@query("label_distances", f"SELECT i, j, {S.rnd('d')} AS d FROM ({DIST_SQL})")
def label_distances(spark, d):
    """Distance fixture: Euclidean distance of per-label mean embeddings."""
    return CL.label_distances(embedding_rows(spark, d), "label", "embedding")


_ASSIGN_SQL = f"""
WITH dd AS (SELECT i, j, CASE WHEN i = j THEN 0 ELSE d END AS d FROM ({DIST_SQL})),
c AS (SELECT j AS point, i AS medoid, d, CASE i {' '.join(f'WHEN {m} THEN {k}' for k, m in enumerate(MEDOIDS))} END AS o
      FROM dd WHERE i IN ({', '.join(map(str, MEDOIDS))}))
SELECT point, medoid FROM (SELECT *, row_number() OVER (PARTITION BY point ORDER BY d, o) AS rn FROM c) WHERE rn = 1
"""


@query("kmedoids_assign", _ASSIGN_SQL)
def kmedoids_assign(spark, d):
    """L5 step: nearest of the medoids 0, 1, 2 for every label."""
    return CL.kmedoids_assign(CL.label_distances(embedding_rows(spark, d), "label", "embedding"), MEDOIDS)


def _medoids_sql(steps=12):
    """The loop unrolled: assignment to the nearest medoid, then the member with the
    least mean distance; more steps than the test tables need to settle."""
    parts = [
        f"dd AS MATERIALIZED (SELECT i, j, CASE WHEN i = j THEN 0 ELSE d END AS d FROM ({DIST_SQL}))",
        f"m0 AS (SELECT unnest([{', '.join(map(str, MEDOIDS))}]) AS medoid, unnest(range({len(MEDOIDS)})) AS o)",
    ]
    for t in range(steps):
        parts.append(
            f"a{t} AS MATERIALIZED (SELECT j AS point, medoid FROM dd JOIN m{t} ON i = medoid QUALIFY row_number() OVER (PARTITION BY j ORDER BY d, o) = 1)"
        )
        parts.append(
            f"c{t} AS (SELECT x.medoid AS ci, j, avg(d) AS m FROM dd JOIN a{t} x ON x.point = i JOIN a{t} y ON y.point = j WHERE x.medoid = y.medoid GROUP BY ALL)"
        )
        parts.append(
            f"m{t + 1} AS MATERIALIZED (SELECT j AS medoid, row_number() OVER (ORDER BY ci) - 1 AS o FROM (SELECT *, row_number() OVER (PARTITION BY ci ORDER BY m, j) AS r FROM c{t}) WHERE r = 1)"
        )
    last = f"a{steps - 1}"
    parts.append(f"b AS (SELECT x.medoid AS ci, y.medoid AS cj, avg(d) AS m FROM dd JOIN {last} x ON x.point = i JOIN {last} y ON y.point = j GROUP BY ALL)")
    parts.append(
        "s AS (SELECT cj AS medoid, any_value(m) FILTER (ci = cj) AS a, min(m) FILTER (ci <> cj) AS b FROM b GROUP BY cj)"
    )
    return f"WITH {', '.join(parts)} SELECT medoid, point, {S.rnd('(b - a) / greatest(a, b)')} AS silhouette FROM {last} JOIN s USING (medoid)"


@query("kmedoids", _medoids_sql())
def kmedoids(spark, d):
    """K-medoids (k = 3) to convergence, with per-cluster silhouette."""
    dist = CL.label_distances(embedding_rows(spark, d), "label", "embedding")
    assign, sil = CL.kmedoids(dist, MEDOIDS)
    return assign.join(sil, "medoid", "left")


def _emb_train(spark, d):
    return MD.with_weights(_vectors(spark, d))


@query("gbt_train")
def gbt_train(spark, d):
    """M1: weighted GBT on embeddings (y = label < 3); train probabilities."""
    df = _emb_train(spark, d)
    m = MD.gbt(maxIter=10, maxDepth=3).fit(df)
    return MD.score(m, df, key="vec_id")


@query("stacking")
def stacking(spark, d):
    """M2: GBT + random forest probabilities stacked by a logistic learner."""
    df = _vectors(spark, d)
    m = MD.stacking(df, [MD.gbt(weight=None, maxIter=10, maxDepth=3), MD.rf(numTrees=20, maxDepth=4)])
    return MD.score(m, df, key="vec_id")


@query("grid_search")
def grid_search(spark, d):
    """M3: 3-fold CV over a 2 x 2 GBT grid on ROC AUC; CV metric per point."""
    df = _vectors(spark, d)
    cv = MD.grid_search(df, MD.gbt(weight=None), {"maxDepth": [2, 3], "maxIter": [5, 10]})
    rows = [(str({p.name: v for p, v in pm.items()}), float(a)) for pm, a in zip(cv.getEstimatorParamMaps(), cv.avgMetrics)]
    return spark.createDataFrame(rows, "params string, mean_auc double")


@query("random_search")
def random_search(spark, d):
    """M4: 3 random draws x 2 hash shuffle-splits (33 %) of logistic models."""
    df = _vectors(spark, d)
    res, _ = MD.random_search(
        df,
        lambda regParam, maxIter: MD.LogisticRegression(featuresCol="features", labelCol="y", regParam=regParam, maxIter=maxIter),
        {"regParam": ("log", 1e-4, 1.0), "maxIter": ("int", 5, 20)},
        draws=3,
        splits=2,
        key="vec_id",
    )
    return res


def _trend_tables(spark, d):
    feats = interval_features(log_events(spark, d))
    ids = ids_events(spark, d)
    tab = fill_policy(ids.select("FileID", "y", "split").join(feats, "FileID", "left"))
    cols = [c for c in tab.columns if c not in ("FileID", "y", "split")]
    return CL.as_vector(tab, cols)


@query("score_test")
def score_test(spark, d):
    """Train weighted GBT on training files, score the test files."""
    tab = _trend_tables(spark, d)
    m = MD.gbt(maxIter=10, maxDepth=3).fit(MD.with_weights(tab.where(F.col("split") == "train")))
    return MD.score(m, tab.where(F.col("split") == "test"))


@query(
    "search_refit_score",
    f"SELECT count(*) AS files, count(*) AS scored, true AS probabilities FROM {S.IDS_EVENTS} WHERE split = 'test'",
)
def search_refit_score(spark, d):
    """A weighted stack searched, refit and scored; of the written
    predictions: test files, distinct files, and whether all are probabilities."""
    tab = cut_lineage(_trend_tables(spark, d))
    found, _ = MD.search_refit_score(
        MD.with_weights(tab.where(F.col("split") == "train")),
        tab.where(F.col("split") == "test"),
        lambda c, depth: MD.Stack([MD.gbt(maxIter=3, maxDepth=depth), MD.rf(numTrees=5, maxDepth=depth)], c),
        {"c": ("log", 0.01, 1.0), "depth": ("int", 2, 3)},
        scratch(spark, "predictions"),
        draws=2,
    )
    p = F.col("probability")
    return found.agg(
        F.count("*").alias("files"), F.count_distinct("FileID").alias("scored"), F.bool_and(p.between(0, 1)).alias("probabilities")
    )


@query("model_roundtrip")
def model_roundtrip(spark, d):
    """Save a fitted pipeline to the shared checkpoint folder, reload it,
    and score with the reloaded copy."""
    tab = _trend_tables(spark, d)
    model = Pipeline(stages=[MD.gbt(weight=None, maxIter=5, maxDepth=2)]).fit(tab.where(F.col("split") == "train"))
    path = scratch(spark, "model")
    MD.save_model(model, path)
    return MD.score(MD.load_pipeline(path), tab.where(F.col("split") == "test"))


# ------------------------------------------------- learnable rules, row by row
RULE = "CAST(floor(value / 50) AS INTEGER) >= 5"
_RULE_SQL = f"SELECT event_id, CAST({RULE} AS INTEGER) AS said FROM events"


def _rule_rows(spark, d):
    """Events with the class that a rule on one of two features gives them; the
    features have few values, so trees can cut exactly at the rule."""
    ev = spark.read.parquet(f"{d}/events.parquet")
    step = F.floor(F.col("value") / 50).cast("double")
    rows = ev.select("event_id", step.alias("step"), F.pmod(F.col("user_id"), F.lit(7)).cast("double").alias("noise"))
    return cut_lineage(CL.as_vector(rows.withColumn("y", (F.col("step") >= 5).cast("int")), ["noise", "step"]))


def _said(model, rows):
    return MD.score(model, rows, key="event_id").select("event_id", (F.col("probability") > 0.5).cast("int").alias("said"))


@query("gbt_rule", _RULE_SQL)
def gbt_rule(spark, d):
    """Weighted trees learn a rule exactly; the class said for every row."""
    rows = _rule_rows(spark, d)
    return _said(MD.gbt(maxIter=5, maxDepth=3).fit(MD.with_weights(rows)), rows)


@query("stacking_rule", _RULE_SQL)
def stacking_rule(spark, d):
    """M2: the stack learns the rule."""
    rows = _rule_rows(spark, d)
    bases = [MD.gbt(weight=None, maxIter=3, maxDepth=2), MD.rf(numTrees=5, maxDepth=3, featureSubsetStrategy="all")]
    return _said(MD.stacking(rows, bases), rows)


@query("model_roundtrip_rule", _RULE_SQL)
def model_roundtrip_rule(spark, d):
    """A saved and reloaded pipeline says the same, written and read back."""
    rows = _rule_rows(spark, d)
    path = scratch(spark, "rule")
    MD.save_model(Pipeline(stages=[MD.gbt(weight=None, maxIter=3, maxDepth=2)]).fit(rows), f"{path}/model")
    _said(MD.load_pipeline(f"{path}/model"), rows).write.mode("overwrite").parquet(f"{path}/said")
    return spark.read.parquet(f"{path}/said")


@query("search_rule", f"SELECT event_id, CAST({RULE} AS INTEGER) AS said, true AS found FROM events WHERE event_id % 5 = 0")
def search_rule(spark, d):
    """M3/M4: the search prefers the deeper trees, without which the rule of two
    features can't be learnt from the noisy one; held-out rows scored."""
    rows = _rule_rows(spark, d)
    held = F.col("event_id") % 5 == 0
    path = scratch(spark, "search-rule")
    made = lambda depth, lone: MD.gbt(weight=None, maxIter=3, maxDepth=depth, maxBins=32, minInfoGain=lone)
    found, best = MD.search_refit_score(
        rows.where(~held), rows.where(held), made, {"depth": [0, 2], "lone": [0.0]}, path, draws=4, key="event_id"
    )
    return found.select("event_id", (F.col("probability") > 0.5).cast("int").alias("said"), F.lit(best["depth"] == 2).alias("found"))


@query(
    "gmm_planted",
    "SELECT CAST(user_id % 3 AS BIGINT) AS planted, count(*) AS n, 1::BIGINT AS clusters, 3::BIGINT AS of FROM events GROUP BY 1",
)
def gmm_planted(spark, d):
    """L1/L2: three far groups of events; of sizes 2 to 4 with every kind of
    covariance the mixture of least AIC among those of 3 separates them."""
    from logweave.operators import mixtures as G

    ev = spark.read.parquet(f"{d}/events.parquet")
    group = F.pmod(F.col("user_id"), F.lit(3))
    x = F.array(group * 1000 + F.pmod(F.xxhash64("event_id"), F.lit(100)) / 10, F.pmod(F.xxhash64(F.lit(1), "event_id"), F.lit(100)) / 10 - group * 500)
    rows = cut_lineage(ev.select(group.alias("planted"), x.alias("features")))
    _, best = G.select_mixture(rows, [3], ("diag", "full"), max_iter=10)
    found = G.assign(rows, best)
    total = found.select("prediction").distinct().count()
    return found.groupBy("planted").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("prediction").alias("clusters")).withColumn("of", F.lit(total).cast("long"))
