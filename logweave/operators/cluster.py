"""Clustering and proximity: GMM selection, PCA spectrum, random-forest
proximity between labels, k-medoids on a long distance table."""

from __future__ import annotations

import warnings
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import GaussianMixture
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweave.session import cut_lineage


def as_vector(df: DataFrame, cols: Sequence[str] | str, out: str = "features") -> DataFrame:
    """Array column or numeric columns -> ML vector column."""
    if isinstance(cols, str):
        return df.withColumn(out, array_to_vector(F.col(cols).cast("array<double>")))
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="keep").transform(df)


def standardize_vector(df: DataFrame, inp: str = "features", out: str = "scaled") -> DataFrame:
    """Centre and scale by the population std (zero std -> 1), as the
    reference's scaler; Spark's scaler uses the sample std, so rescale."""
    n = df.count()
    model = StandardScaler(inputCol=inp, outputCol="_s", withMean=True, withStd=True).fit(df)
    fix = ((n - 1) / n) ** 0.5 if n > 1 else 1.0
    std = model.std.toArray()
    scale = [1.0 / fix if s > 0 else 1.0 for s in std]  # sample -> population
    arr = vector_to_array(F.col("_s"))
    scaled = F.transform(arr, lambda v, i: v * F.element_at(F.array(*[F.lit(x) for x in scale]), i + 1))
    return model.transform(df).withColumn(out, array_to_vector(scaled)).drop("_s")


def gmm_parameters(k: int, d: int) -> int:
    """Free parameters of a full-covariance GMM: means, covariances, weights."""
    return k * d + k * d * (d + 1) // 2 + k - 1


def gmm_select(df: DataFrame, ks: Sequence[int], features: str = "features", seed: int = 42, max_iter: int = 100):
    """L1: fit a full-covariance GMM per k; pick the minimum AIC.

    Returns (aic table DataFrame, best model).  AIC = 2p - 2 log L.
    """
    d = len(df.select(features).first()[0])
    rows, best, best_aic = [], None, float("inf")
    for k in ks:
        m = GaussianMixture(k=k, featuresCol=features, seed=seed, maxIter=max_iter).fit(df)
        ll = m.summary.logLikelihood
        aic = 2 * gmm_parameters(k, d) - 2 * ll
        rows.append((k, float(ll), float(aic)))
        if aic < best_aic:
            best, best_aic = m, aic
    table = df.sparkSession.createDataFrame(rows, "k int, log_likelihood double, aic double")
    return table, best


def pca_spectrum(df: DataFrame, k: int, features: str = "scaled") -> DataFrame:
    """L3: ``(component, ratio, variance)`` of the first k principal axes of
    centred data; variance = ratio x total variance of the inputs."""
    model = PCA(k=k, inputCol=features, outputCol="pca").fit(df)
    ratios = model.explainedVariance.toArray().tolist()
    tot = df.select(vector_to_array(F.col(features)).alias("a")).select(
        F.posexplode("a").alias("i", "v")
    ).groupBy("i").agg(F.var_samp("v").alias("var")).agg(F.sum("var")).first()[0]
    rows = [(i, float(r), float(r * tot)) for i, r in enumerate(ratios)]
    return df.sparkSession.createDataFrame(rows, "component int, ratio double, variance double")


def rf_proximity(
    df: DataFrame,
    label: str,
    target: str,
    features: str = "features",
    trees: int = 10,
    seed: int = 42,
) -> DataFrame:
    """L4: proximity distances between labels from a random forest regressor."""
    rf = RandomForestRegressor(featuresCol=features, labelCol=target, numTrees=trees, seed=seed, leafCol="leaf")
    leaves = rf.fit(df).transform(df).select(
        F.col(label).alias("lab"), F.posexplode(vector_to_array("leaf")).alias("tree", "leaf")
    )
    return leaf_distances(leaves, trees)


# The result of leaf_distances without a list is a matrix of so many labels at most.
MAX_LABELS = 2000


def leaf_pairs(leaves: DataFrame, trees: int) -> DataFrame:
    """``leaf_distances`` without a bound on labels: ``(a, b, distance)`` for the
    pairs that share a leaf; all others are at distance 1."""
    c = leaves.groupBy("tree", "leaf", "lab").agg(F.count(F.lit(1)).alias("c"))
    return _near(c, _sizes(c, trees), trees)


def _sizes(c: DataFrame, trees: int) -> DataFrame:
    return cut_lineage(c.groupBy("lab").agg((F.sum("c") / trees).cast("long").alias("n")))


# Labels of a tile: a task holds one tile's counts against another's.
TILE_LABELS = 1024


def _shared(one: tuple, two: tuple) -> np.ndarray:
    """Rows sharing a leaf, of every label of one tile with every label of another:
    the sum over leaves of the products of their counts.  Leaves are given as
    (row, leaf, count); those of many labels are multiplied as matrices, the others
    pair by pair."""
    (ra, la, ca, na), (rb, lb, cb, nb) = one, two
    both = np.intersect1d(la, lb)
    (ra, la, ca), (rb, lb, cb) = ((r[m], np.searchsorted(both, l[m]), c[m]) for r, l, c, m in ((ra, la, ca, np.isin(la, both)), (rb, lb, cb, np.isin(lb, both))))
    out = np.zeros((na, nb), np.int64)
    ka, kb = np.bincount(la, minlength=len(both)), np.bincount(lb, minlength=len(both))
    crowded = ka * kb * 16 >= na * nb
    at = np.flatnonzero(crowded)
    most = int(ca.max(initial=0)) * int(cb.max(initial=0)) * max(1, len(at))
    kind = np.float64 if most < 2**53 else np.int64  # products of floats are exact below
    for k in range(0, len(at), 512):
        some = at[k : k + 512]
        a, b = np.zeros((na, len(some)), kind), np.zeros((nb, len(some)), kind)
        for m, r, l, c in ((a, ra, la, ca), (b, rb, lb, cb)):
            own = np.isin(l, some)
            m[r[own], np.searchsorted(some, l[own])] = c[own]
        out += (a @ b.T).astype(np.int64)
    own = ~crowded[lb]
    order = np.argsort(lb[own], kind="stable")
    rb, cb, lb = rb[own][order], cb[own][order], lb[own][order]
    start, size = np.searchsorted(lb, np.arange(len(both))), np.where(crowded, 0, kb)
    own = np.flatnonzero(~crowded[la])
    for k in range(0, len(own), 4096):
        some = own[k : k + 4096]
        many = size[la[some]]
        left = np.repeat(some, many)
        right = np.arange(len(left)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(start[la[some]], many)
        np.add.at(out, (ra[left], rb[right]), ca[left] * cb[right])
    return out


def _near(c: DataFrame, n: DataFrame, trees: int) -> DataFrame:
    """Labels are dealt into tiles, and every pair of tiles is a product of their counts
    per leaf in one task: what is shuffled is one row per label and tile, and the pairs of
    labels, which can be most of all, are the output only."""
    tiles = -(-n.count() // TILE_LABELS) or 1
    c = c.where("tree is not null and leaf is not null and lab is not null")
    numbers = cut_lineage(c.select("tree", "leaf").distinct().withColumn("_leaf", F.monotonically_increasing_id()))
    rows = c.join(numbers, ["tree", "leaf"]).groupBy("lab").agg(F.collect_list(F.struct("_leaf", "c")).alias("_l"))
    tile = F.pmod(F.xxhash64("lab"), F.lit(tiles)).cast("int")
    rows = cut_lineage(rows.join(n, "lab").select("lab", "n", F.col("_l._leaf").alias("leaves"), F.col("_l.c").alias("counts"), tile.alias("_t")))
    other = F.explode(F.sequence(F.lit(0), F.lit(tiles - 1))).alias("_o")
    parts = min(tiles * (tiles + 1) // 2, int(c.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    sides = []
    for i, j, upper in (("_t", "_o", "_t <= _o"), ("_o", "_t", "_o <= _t")):
        # Columns of its own: both sides come from one table.
        own = [F.col(x).alias(y) for x, y in ((i, "_i"), (j, "_j"), *[(x, x) for x in ("lab", "n", "leaves", "counts")])]
        side = rows.select("*", other).where(upper).select(*own)
        sides.append(side.repartition(parts, "_i", "_j").groupBy("_i", "_j"))

    def unpacked(t: pa.Table) -> tuple:
        leaves, counts = (t.column(x).combine_chunks() for x in ("leaves", "counts"))
        row = np.repeat(np.arange(len(t)), leaves.value_lengths().to_numpy(zero_copy_only=False))
        return row, leaves.flatten().to_numpy(), counts.flatten().to_numpy(), len(t)

    def run(one: pa.Table, two: pa.Table) -> pa.Table:
        names, out = ["a", "b", "_s", "na", "nb"], []
        if len(one) and len(two):
            s = _shared(unpacked(one), unpacked(two))
            labels = [t.column("lab").combine_chunks() for t in (one, two)]
            sizes = [t.column("n").combine_chunks() for t in (one, two)]
            mirrored = one.column("_i")[0].as_py() != one.column("_j")[0].as_py()
            for k in range(0, len(one), 64):
                x, y = np.nonzero(s[k : k + 64])
                sums, x, y = pa.array(s[k + x, y]), pa.array(k + x), pa.array(y)
                a, b, na, nb = labels[0].take(x), labels[1].take(y), sizes[0].take(x), sizes[1].take(y)
                out.append(pa.table([a, b, sums, na, nb], names))
                if mirrored:
                    out.append(pa.table([b, a, sums, nb, na], names))
        kind = one.schema.field("lab").type
        return pa.concat_tables(out) if out else pa.schema([("a", kind), ("b", kind), *[(x, pa.int64()) for x in names[2:]]]).empty_table()

    kind = n.schema["lab"].dataType.simpleString()
    s = sides[0].cogroup(sides[1]).applyInArrow(run, f"a {kind}, b {kind}, _s bigint, na bigint, nb bigint")
    num = F.when(F.col("a") == F.col("b"), (F.col("_s") + trees * F.col("na")) / 2).otherwise(F.col("_s"))
    return s.select("a", "b", (1 - num / (trees * F.col("na") * F.col("nb"))).alias("distance"))


def leaf_distances(leaves: DataFrame, trees: int, labels: Sequence | None = None) -> DataFrame:
    """L4, the relational part: ``(lab, tree, leaf)`` rows (one per row and tree)
    -> ``(a, b, distance)`` for every pair of labels,

        1 - (rows of labels a and b sharing a leaf) / (trees * n_a * n_b);

    labels that never share a leaf are at distance 1.  The same-leaf count is
    a product of tiles of per-(tree, leaf, label) counts, not a row-pair loop.  For
    a = b ordered pairs i >= j count, i.e. (sum c^2 + trees n) / 2.

    The dense matrix is made for the ``labels`` that the caller lists, or for all
    if there are at most ``MAX_LABELS``; ``leaf_pairs`` takes any number.
    """
    if labels is not None:
        leaves = leaves.where(F.col("lab").isin(list(labels)))
    c = leaves.groupBy("tree", "leaf", "lab").agg(F.count(F.lit(1)).alias("c"))
    n = _sizes(c, trees)
    if labels is None and n.count() > MAX_LABELS:
        raise ValueError(f"more than {MAX_LABELS} labels: list those wanted, or use leaf_pairs")
    every = n.select(F.col("lab").alias("a")).crossJoin(n.select(F.col("lab").alias("b")))
    return every.join(_near(c, n, trees), ["a", "b"], "left").select("a", "b", F.coalesce("distance", F.lit(1.0)).alias("distance"))


def label_distances(df: DataFrame, label: str, vec: str) -> DataFrame:
    """Pairwise Euclidean distance of per-label mean vectors (long i, j, d)."""
    e = df.select(F.col(label).alias("lab"), F.posexplode(F.col(vec)).alias("pos", "v"))
    mean = e.groupBy("lab", "pos").agg(F.avg("v").alias("m"))
    a = mean.select(F.col("lab").alias("i"), "pos", F.col("m").alias("mi"))
    b = mean.select(F.col("lab").alias("j"), "pos", F.col("m").alias("mj"))
    return a.join(b, "pos").groupBy("i", "j").agg(
        F.sqrt(F.sum((F.col("mi") - F.col("mj")) ** 2)).alias("d")
    )


def kmedoids_assign(dist: DataFrame, medoids: Sequence) -> DataFrame:
    """One k-medoids assignment: each point to its nearest medoid (diagonal
    zeroed; ties go to the medoid listed first)."""
    order = F.create_map(*[x for k, m in enumerate(medoids) for x in (F.lit(m), F.lit(k))])
    d = dist.withColumn("d", F.when(F.col("i") == F.col("j"), F.lit(0.0)).otherwise(F.col("d")))
    m = d.where(F.col("i").isin(list(medoids))).select(
        F.col("i").alias("medoid"), F.col("j").alias("point"), "d", F.element_at(order, F.col("i")).alias("_o")
    )
    return m.groupBy("point").agg(F.min_by("medoid", F.struct("d", "_o")).alias("medoid"))


def kmedoids(dist: DataFrame, medoids: Sequence, tmax: int = 100) -> tuple[DataFrame, DataFrame]:
    """K-medoids with silhouette per cluster.

    Loop: assign to nearest medoid; new medoid of a cluster = member with
    the least mean distance to the cluster; stop when memberships repeat.
    Each iteration's assignment is checkpointed to the shared checkpoint
    folder (reliable lineage cut).  The medoid list (k values) is the only
    state kept on the driver.  Returns (assignment, silhouette).
    """
    d = cut_lineage(dist.withColumn("d", F.when(F.col("i") == F.col("j"), F.lit(0.0)).otherwise(F.col("d"))))
    meds = list(medoids)
    for _ in range(tmax):
        assign = cut_lineage(kmedoids_assign(d, meds))
        mi = assign.select(F.col("point").alias("i"), F.col("medoid").alias("ci"))
        mj = assign.select(F.col("point").alias("j"), F.col("medoid").alias("cj"))
        inner = d.join(mi, "i").join(mj, "j").where(F.col("ci") == F.col("cj"))
        cand = inner.groupBy("ci", "j").agg(F.avg("d").alias("m"))
        new = cand.groupBy("ci").agg(F.min_by("j", F.struct("m", "j")).alias("medoid"))
        new_meds = [r.medoid for r in new.orderBy("ci").collect()]  # k values
        # Assignments are a function of the medoid set: same set -> converged.
        if set(new_meds) == set(meds):
            break
        meds = new_meds
    else:
        warnings.warn(f"k-medoids did not converge in {tmax} iterations", stacklevel=2)
    assign = kmedoids_assign(d, meds)
    return assign, silhouette(d, assign)


def silhouette(d: DataFrame, assign: DataFrame) -> DataFrame:
    """Per cluster: a = mean distance inside (diagonal included), b = least
    mean distance to another cluster; (b - a) / max(a, b).  NULL for k = 1."""
    mi = assign.select(F.col("point").alias("i"), F.col("medoid").alias("ci"))
    mj = assign.select(F.col("point").alias("j"), F.col("medoid").alias("cj"))
    blocks = d.join(mi, "i").join(mj, "j").groupBy("ci", "cj").agg(F.avg("d").alias("m"))
    a = blocks.where(F.col("ci") == F.col("cj")).select(F.col("cj").alias("c"), F.col("m").alias("a"))
    b = blocks.where(F.col("ci") != F.col("cj")).groupBy(F.col("cj").alias("c")).agg(F.min("m").alias("b"))
    s = a.join(b, "c", "left")
    return s.select(
        F.col("c").alias("medoid"),
        F.try_divide(F.col("b") - F.col("a"), F.greatest(F.col("a"), F.col("b"))).alias("silhouette"),
    )

