"""Per-key descriptive statistics with pandas-of-2018 semantics.

Every statistic is computed from a *value-compressed* fact table
``(keys..., x, w)`` where ``w`` is how many facts carry value ``x``:

1. ``groupBy(keys, x).count()`` -- partial aggregation runs map-side and
   the shuffle is hashed on ``(keys, x)``, so one key holding a third of
   all rows is still spread over many tasks.  Counts, intervals and other
   integer facts compress by orders of magnitude.
2. one ``groupBy(keys)`` pass: n, size, sum, min, max, distinct values and
   exact quantiles via ``percentile(x, array(q...), w)`` (linear
   interpolation, same as ``numpy.percentile``); the quantile buffer is a
   value -> count map, so it is bounded by distinct values, not rows.
3. central moments about the key mean (two-pass, numerically stable):
   ``sum w(x-mu)^2``, ``sum w(x-mu)^3``, ``sum w|x-mu|``, with ``mu`` from
   a window over the key's compressed rows, so steps 2 and 3 are one
   aggregate on one partitioning and the input is read once.

Implicit zeros (pivot cells that pandas fills with 0) are passed as an
extra compressed row ``(keys, 0.0, zeros)`` instead of being materialised.

Semantics (pandas): NULLs are skipped by every statistic except ``size``;
``std`` is the sample std; ``skew`` is the bias-corrected G1, 0 for zero
variance and undefined below 3 values; ``mad`` is the mean absolute
deviation about the mean; missing results become 0 (``fillna(0)``).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

# Fixed stat lists of the reference feature exports (names as emitted).
F9 = ("mean", "std", "max", "min", "median", "skew", "mad", "percentile_25", "percentile_75")
F11 = ("sum", "size") + F9
F5 = ("sum", "mean", "std", "skew", "mad")
F12 = (
    "mean", "std", "count", "nunique", "max", "min", "median", "sum", "skew", "mad",
    "percentile_25", "percentile_75",
)

_MOMENT_STATS = {"std", "std_pop", "skew", "mad"}
KNOWN = {
    "sum", "size", "count", "nunique", "mean", "std", "std_pop", "max", "min", "ptp",
    "median", "skew", "mad",
}


def quantile_of(stat: str) -> float | None:
    """``median`` -> 0.5, ``percentile_25`` -> 0.25, anything else None."""
    if stat == "median":
        return 0.5
    if stat.startswith("percentile_"):
        return float(stat.split("_", 1)[1]) / 100.0
    return None


def _check(stats: Sequence[str]) -> None:
    for s in stats:
        if s not in KNOWN and quantile_of(s) is None:
            raise ValueError(f"unknown statistic {s!r}")


def compress(facts: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """``(keys, value)`` facts -> ``(keys, x, w)``; NULL values kept as x=NULL.

    Integer-valued facts keep an integral copy ``xi`` for exact sums.
    """
    comp = facts.groupBy(*keys, F.col(value).alias("_v")).agg(F.count(F.lit(1)).alias("w"))
    comp = comp.withColumn("x", F.col("_v").cast("double"))
    if isinstance(facts.schema[value].dataType, IntegralType):
        comp = comp.withColumn("xi", F.col("_v").cast("long"))
    return comp.drop("_v")


def with_zeros(comp: DataFrame, keys: Sequence[str], zeros: DataFrame) -> DataFrame:
    """Add implicit zeros: ``zeros`` has ``keys + ['zeros']`` (a count)."""
    z = zeros.where(F.col("zeros") > 0).select(
        *keys, F.lit(0.0).alias("x"), F.col("zeros").cast("long").alias("w")
    )
    if "xi" in comp.columns:
        z = z.withColumn("xi", F.lit(0).cast("long"))
    return comp.unionByName(z)


def describe_compressed(
    comp: DataFrame,
    keys: Sequence[str],
    stats: Sequence[str],
    name: Callable[[str], str] = lambda s: s,
    null_poison: bool = False,
    fill: float | None = 0.0,
    distinct_rows: bool = True,
) -> DataFrame:
    """Statistics over a compressed ``(keys, x, w)`` table.

    One lineage: the weighted key mean comes from a window over the
    compressed rows of the key (bounded by its distinct values), and every
    statistic is then one aggregate on that same partitioning -- two
    shuffles in total counting the compression, and the input is read once.
    ``distinct_rows`` says (keys, x) rows are unique, so distinct values can
    be counted without a distinct aggregate.
    """
    _check(stats)
    keys = list(keys)
    x, w = F.col("x"), F.col("w")
    wn = F.when(x.isNotNull(), w)
    need_mu = bool(_MOMENT_STATS & set(stats))
    # Rows of a key in value order: the window and the aggregate below
    # share this partitioning, so every float sum is taken in the same
    # order on every run (results do not depend on arrival order).
    kw = Window.partitionBy(*keys).orderBy("x").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    if need_mu:
        comp = comp.withColumn("_mu", F.sum(x * w).over(kw) / F.sum(wn).over(kw))
        exact = "xi" in comp.columns
        if exact:
            # Integer facts: s and n are exact, and n * sum w|x - mu| =
            # sum w |n x - s| is an integer sum (decimal(38,0), no rounding).
            comp = comp.withColumn("_sl", F.sum(F.col("xi") * w).over(kw)).withColumn("_nl", F.sum(wn).over(kw))
    aggs: list[Column] = [
        F.sum(wn).alias("_n"),
        F.sum(w).alias("_size"),
        F.sum(x * w).alias("_s"),
        F.min(x).alias("_min"),
        F.max(x).alias("_max"),
    ]
    if "nunique" in stats:
        nu = F.count(x) if distinct_rows else F.count_distinct(x)
        aggs.append(nu.alias("_nu"))
    qs = sorted({q for q in (quantile_of(s) for s in stats) if q is not None})
    whole = "xi" in comp.columns
    if qs and whole:
        # Exact, linear interpolation, weighted by the compressed count.  Integer
        # facts (counts, seconds) have few distinct values per key.
        aggs.append(F.expr("percentile(x, array(" + ", ".join(repr(q) for q in qs) + "), w)").alias("_q"))
    elif qs:
        # Continuous facts: a percentile buffer would hold every value of a key.
        # Running counts in the sorted window (it spills) find the values that hold
        # the two ranks around q (n - 1).
        end = F.sum(F.coalesce(wn, F.lit(0))).over(
            Window.partitionBy(*keys).orderBy("x").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        )
        comp = comp.withColumns({"_end": end, "_all": F.sum(wn).over(kw)})
        for i, q in enumerate(qs):
            at = F.lit(q) * (F.col("_all") - 1)
            for side, rank in (("lo", F.floor(at)), ("hi", F.ceil(at))):
                here = x.isNotNull() & (F.col("_end") - w <= rank) & (rank < F.col("_end"))
                aggs.append(F.max(F.when(here, x)).alias(f"_{side}{i}"))
    if need_mu:
        if "xi" in comp.columns:
            # Integer facts, scaled by n: d = n x - s is an exact integer,
            # m2 = sum w d^2 / n^2, m3 = sum w d^3 / n^3, mad numerator exact.
            dec = "decimal(38,0)"
            dn = F.col("_nl").cast(dec) * F.col("xi").cast(dec) - F.col("_sl").cast(dec)
            dd = dn.cast("double")
            aggs += [
                F.sum(w * dd * dd).alias("_m2s"),
                F.sum(w * dd * dd * dd).alias("_m3s"),
                F.sum(F.when(x.isNotNull(), w.cast(dec) * F.abs(dn))).alias("_adn"),
            ]
        else:
            d = x - F.col("_mu")
            aggs += [
                F.sum(w * d * d).alias("_m2"),
                F.sum(w * d * d * d).alias("_m3"),
                F.sum(w * F.abs(d)).alias("_ad"),
            ]
    first = comp.groupBy(*keys).agg(*aggs)

    n = F.col("_n")
    nd = n.cast("double")
    scaled = "_m2s" in first.columns
    if scaled:
        # m2 = M2 / n^2 and m3 / m2^1.5 = M3 / M2^1.5 (scale-free)
        m2, m3 = F.col("_m2s"), F.col("_m3s")
        m2_per_n2 = m2 / (nd * nd)
    elif need_mu:
        m2, m3 = F.col("_m2"), F.col("_m3")
        m2_per_n2 = m2
    else:
        m2 = m3 = m2_per_n2 = None
    out: list[Column] = [F.col(k) for k in keys]
    for s in stats:
        q = quantile_of(s)
        if s == "sum":
            c = F.coalesce(F.col("_s"), F.lit(0.0))
        elif s == "size":
            c = F.col("_size")
        elif s == "count":
            c = F.coalesce(n, F.lit(0)).cast("long")
        elif s == "nunique":
            c = F.col("_nu").cast("long")
        elif s == "mean":
            c = F.col("_s") / n
        elif s == "std":
            c = F.when(n > 1, F.sqrt(F.greatest(m2_per_n2, F.lit(0.0)) / (n - 1)))
        elif s == "std_pop":
            c = F.sqrt(F.greatest(m2_per_n2, F.lit(0.0)) / n)
        elif s == "ptp":
            c = F.col("_max") - F.col("_min")
        elif s == "min":
            c = F.col("_min")
        elif s == "max":
            c = F.col("_max")
        elif s == "skew":
            zero = (m2 == 0) if scaled else (F.abs(m2) < 1e-14)
            c = F.when(
                n > 2,
                F.when(zero, F.lit(0.0)).otherwise(n * F.sqrt(n - 1) * m3 / ((n - 2) * (m2 * F.sqrt(m2)))),
            )
        elif s == "mad":
            if scaled:
                # one rounding: exact integer numerator over n^2
                c = F.col("_adn").cast("double") / (n.cast("double") * n.cast("double"))
            else:
                c = F.col("_ad") / n
        else:
            i, at = qs.index(q), F.lit(q) * (n - 1)
            c = F.col("_q")[i] if whole else F.col(f"_lo{i}") + (at - F.floor(at)) * (F.col(f"_hi{i}") - F.col(f"_lo{i}"))
            if null_poison and s.startswith("percentile_"):
                # numpy.percentile over data holding NaN returns NaN (-> 0);
                # pandas' own median skips NaN.
                c = F.when(n < F.col("_size"), F.lit(0.0)).otherwise(c)
        out.append(c.alias(name(s)))
    res = first.select(*out)
    if fill is not None:
        res = res.fillna(fill)
    return res


def describe(
    facts: DataFrame,
    keys: Sequence[str],
    value: str,
    stats: Sequence[str],
    name: Callable[[str], str] = lambda s: s,
    zeros: DataFrame | None = None,
    null_poison: bool = False,
    fill: float | None = 0.0,
) -> DataFrame:
    """Per-key statistics of ``value`` (see module doc)."""
    comp = compress(facts, keys, value)
    if zeros is not None:
        comp = with_zeros(comp, keys, zeros)
    return describe_compressed(comp, keys, stats, name, null_poison, fill, distinct_rows=zeros is None)


def widen(
    long_stats: DataFrame,
    key: str,
    dim: str,
    stats: Sequence[str],
    values: Sequence[str],
    fill: float | None = 0.0,
) -> DataFrame:
    """Pivot ``(key, dim, stat...)`` into ``{dim}_{stat}`` columns.

    ``values`` must be the explicit, bounded list of dimension values (no
    extra job to discover them).  Cells of a key with no fact are 0, as in
    the reference's final ``fillna(0)``.
    """
    wide = (
        long_stats.groupBy(key)
        .pivot(dim, list(values))
        .agg(*[F.first(s).alias(s) for s in stats])
    )
    def src(v, s):
        # Spark names a single-aggregate pivot column by the value alone.
        return f"`{v}`" if len(stats) == 1 else f"`{v}_{s}`"

    cols = [F.col(key)] + [F.col(src(v, s)).alias(f"{v}_{s}") for v in values for s in stats]
    wide = wide.select(*cols)
    return wide.fillna(fill) if fill is not None else wide
