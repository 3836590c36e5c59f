"""Tabular preparation: drops, null profiles, encodings, imputation.

"Fit" steps (means, medians, modes, level lists) are one aggregate pass whose
small result row is applied as literals -- the estimator pattern of Spark ML.
Level lists are bounded by a checked cardinality.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

from logweave.functions.encode import MIN_GROUP_ROWS, grade
from logweave.functions.quantiles import group_mode, group_quantile
from logweave.session import cut_lineage, small_table


def _q(c: str) -> Column:
    return F.col(f"`{c}`")


def drop_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop the listed columns that exist (no error on absent ones)."""
    return df.drop(*[c for c in cols if c in df.columns])


def string_columns(df: DataFrame) -> list[str]:
    """String-typed columns."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]


def null_counts(df: DataFrame) -> dict[str, int]:
    """One pass: NULL count per column (NaN counts as missing for doubles)."""
    aggs = []
    for f in df.schema.fields:
        miss = _q(f.name).isNull()
        if f.dataType.typeName() in ("double", "float"):
            miss = miss | F.isnan(_q(f.name))
        aggs.append(F.sum(miss.cast("long")).alias(f.name))
    row = df.agg(*aggs).first()
    return {c: int(row[c] or 0) for c in df.columns}


def null_columns(df: DataFrame) -> tuple[list[str], list[str]]:
    """(columns without NULL, columns with NULL)."""
    n = null_counts(df)
    return [c for c in df.columns if n[c] == 0], [c for c in df.columns if n[c] > 0]


def null_profile(df: DataFrame) -> DataFrame:
    """``(column, null_ratio)`` for columns holding NULLs, one pass + unpivot."""
    aggs = [F.avg(_q(c).isNull().cast("double")).alias(c) for c in df.columns]
    wide = df.agg(*aggs)
    long = wide.unpivot([], df.columns, "column", "null_ratio")
    return long.where(F.col("null_ratio") > 0)


def constant_columns(df: DataFrame, cols: Sequence[str] | None = None) -> list[str]:
    """B13 decision: all-NULL columns, or NULL-free columns with min = max.

    Constant-size aggregates only (no distinct counting).
    """
    cols = list(cols or df.columns)
    aggs = []
    for c in cols:
        aggs += [
            F.count(_q(c)).alias(f"n|{c}"),
            F.min(_q(c)).alias(f"lo|{c}"),
            F.max(_q(c)).alias(f"hi|{c}"),
        ]
    aggs.append(F.count(F.lit(1)).alias("__rows"))
    row = df.agg(*aggs).first().asDict()
    out = []
    for c in cols:
        n = row[f"n|{c}"]
        if n == 0 or (n == row["__rows"] and row[f"lo|{c}"] == row[f"hi|{c}"]):
            out.append(c)
    return out


def drop_constant(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Drop columns holding a single value; ``keep`` (keys) stay."""
    return df.drop(*constant_columns(df, [c for c in df.columns if c not in keep]))


def ordinal_map(df: DataFrame, maps: Mapping[str, Mapping[str, int]]) -> DataFrame:
    """H3: grade maps; unmapped -> 0."""
    return df.withColumns({c: grade(c, m) for c, m in maps.items() if c in df.columns})


def label_encode(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """H4: string cells -> index of the value in the sorted distinct strings.

    A column with NULLs counts the class ``'nan'`` in the ordering (the
    reference encodes ``astype(str)``); NULL cells stay NULL.  Non-string
    columns are left as they are.  Codes come from a dense rank over the
    distinct (column, value) table and are joined back.
    """
    cols = [c for c in (cols or df.columns) if c in string_columns(df)]
    if not cols:
        return df
    # The levels of all columns from one pass: cells unpivoted, then distinct.
    cells = F.array(*[F.struct(F.lit(c).alias("_col"), F.coalesce(_q(c), F.lit("nan")).alias("_val")) for c in cols])
    levels = df.select(F.explode(cells).alias("_r")).select("_r._col", "_r._val").distinct()
    codes = levels.withColumn(
        "_code", (F.dense_rank().over(Window.partitionBy("_col").orderBy("_val")) - 1).cast("int")
    )
    # one small code table for all columns: fetched (size checked) and
    # broadcast, so rows of a frequent category are not shuffled together
    codes, small = small_table(codes)
    out = df
    for c in cols:
        m = codes.where(F.col("_col") == c).select(F.col("_val").alias(f"_v_{c}"), F.col("_code").alias(f"_c_{c}"))
        m = F.broadcast(m) if small else m
        out = out.join(m, _q(c) == F.col(f"_v_{c}"), "left").withColumn(c, F.col(f"_c_{c}")).drop(
            f"_v_{c}", f"_c_{c}"
        )
    return out.select(*df.columns)


def levels_of(df: DataFrame, col: str, max_levels: int = 1000) -> tuple[list, bool]:
    """Sorted distinct non-NULL values and whether NULL occurs (bounded)."""
    rows = (
        df.select(_q(col).alias("v")).distinct().limit(max_levels + 2).collect()
    )
    vals = [r.v for r in rows if r.v is not None]
    if len(vals) > max_levels:
        raise ValueError(f"{col} has more than {max_levels} levels: list those wanted, or use one_hot_long")
    return sorted(vals), len(vals) < len(rows)


def one_hot(
    df: DataFrame, cols: Sequence[str], max_levels: int = 1000, levels: Mapping[str, Sequence] | None = None
) -> DataFrame:
    """H5: dummies ``col_value``; first level dropped unless the column has NULLs;
    a NULL row is 0 in every dummy.  The source column is removed.  ``levels``
    lists the dummies of a column as they are; beyond ``max_levels`` without a
    list, ``one_hot_long`` has the same cells for any number of levels."""
    out = df
    for c in cols:
        if levels and c in levels:
            keep = list(levels[c])
        else:
            vals, has_null = levels_of(df, c, max_levels)
            keep = vals if has_null else vals[1:]
        out = out.withColumns(
            {f"{c}_{v}": F.when(_q(c) == F.lit(v), 1).otherwise(0).cast("int") for v in keep}
        ).drop(c)
    return out


def one_hot_long(df: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """H5 without a bound on levels: ``(*keys, column, level)``, one row for each 1
    of the dummies of ``one_hot`` (level as a string).  Its dropped levels, the
    lowest of each column without NULLs, come from one aggregate."""
    if not cols:
        raise ValueError("no columns to encode")
    own = df.agg(*[x for c in cols for x in (F.min(_q(c)), F.bool_or(_q(c).isNull()))]).first()
    cells = []
    for k, c in enumerate(cols):
        low, has_null = own[2 * k], own[2 * k + 1]
        kept = _q(c).isNotNull() if has_null or low is None else _q(c) != F.lit(low)
        cells.append(F.when(kept, F.struct(F.lit(c).alias("column"), _q(c).cast("string").alias("level"))))
    out = df.select(*[_q(k) for k in keys], F.explode(F.array_compact(F.array(*cells))).alias("__cell"))
    return out.select(*[_q(k) for k in keys], "__cell.column", "__cell.level")


# Per-group statistic tables up to this many rows are broadcast to the
# rows being filled; larger ones use an ordinary join.
MAX_BROADCAST_GROUPS = 100_000


def _group_stat(df: DataFrame, keys: Sequence[str], c: str, strategy, out: str) -> DataFrame:
    """Statistic of ``c`` per group (no keys: one global row), bounded per task."""
    if strategy == "mean":
        return df.groupBy(*keys).agg(F.avg(_q(c)).alias(out))
    if strategy == "median":
        return group_quantile(df, keys, c, 0.5, out)
    if strategy == "most_frequent":
        # Ties -> lowest value (pandas idxmax over sorted groups).
        return group_mode(df, keys, c, out)
    raise ValueError(strategy)


def impute_simple(df: DataFrame, spec: Mapping[str, object]) -> DataFrame:
    """H6: fill NULLs with a constant, or the column mean / median / mode.

    Each statistic is one small result (a single value) computed without
    holding a column in one buffer.
    """
    fills: dict[str, object] = {}
    for c, s in spec.items():
        if isinstance(s, str):
            row = _group_stat(df, [], c, s, "v").first()
            fills[c] = row["v"] if row else None
        else:
            fills[c] = s
    return df.withColumns({c: _fill(df, c, spec[c], v) for c, v in fills.items() if v is not None})


def _fill(df: DataFrame, c: str, strategy, value) -> Column:
    """coalesce with the fill value; mean / median fills make the column double."""
    if strategy in ("mean", "median"):
        return F.coalesce(_q(c).cast("double"), F.lit(value).cast("double"))
    return F.coalesce(_q(c), F.lit(value).cast(df.schema[c].dataType))


def impute_by_group(
    df: DataFrame,
    group: str,
    spec: Mapping[str, object],
    min_rows: int = MIN_GROUP_ROWS,
) -> DataFrame:
    """H8: fill each NULL by its group's statistic; groups with fewer than
    ``min_rows`` rows (or no value at all) use the global statistic.
    Strategy 0 fills 0.

    Group statistics come from bounded aggregates (see
    ``functions.quantiles``); the per-group table is fetched when small (its
    size checked) and broadcast to the rows, so a hot group is never
    gathered into one join task; beyond the cap it is checkpointed.
    """
    stat_cols = {c: s for c, s in spec.items() if isinstance(s, str)}
    out = df
    if stat_cols:
        per = df.groupBy(group).agg(F.count(F.lit(1)).alias("_g_rows"))
        for c, s in stat_cols.items():
            per = per.join(_group_stat(df, [group], c, s, f"_g_{c}"), group, "left")
        per, small = small_table(per, MAX_BROADCAST_GROUPS)
        side = F.broadcast(per) if small else per
        glob = {c: (_group_stat(df, [], c, s, "v").first() or {"v": None})["v"] for c, s in stat_cols.items()}
        out = out.join(side, group, "left")
        fills = {}
        for c in stat_cols:
            g = F.lit(glob[c])
            use = F.when(F.col("_g_rows") >= min_rows, F.coalesce(F.col(f"_g_{c}"), g)).otherwise(g)
            typ = "double" if stat_cols[c] in ("mean", "median") else df.schema[c].dataType
            fills[c] = F.coalesce(_q(c).cast(typ), use.cast(typ))
        out = out.withColumns(fills).select(*df.columns)
    zero = {c: _fill(df, c, v, v) for c, v in spec.items() if not isinstance(v, str)}
    return out.withColumns(zero) if zero else out


def fill_policy(df: DataFrame, key: str = "FileID") -> DataFrame:
    """H9: interval std / skew / mad columns (not range) -> 0, everything else -> -1."""
    zero_cols = [
        c
        for c in df.columns
        if "QueryTsInterval" in c
        and any(s in c.lower() for s in ("std", "skew", "mad"))
        and "range" not in c.lower()
    ]
    num = [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType) and f.name != key]
    rest = [c for c in num if c not in zero_cols]
    return df.fillna(0, subset=zero_cols).fillna(-1, subset=rest)


def combine_period(df: DataFrame, year: str, month: str, by: str = "m", out: str | None = None) -> DataFrame:
    """H2: year + quarter (``by='q'``) or year + month key; sources dropped."""
    from logweave.functions.calendar import combine_period as cp

    name = out or ("YQSold" if by == "q" else "YMSold")
    return df.withColumn(name, cp(year, month, by)).drop(year, month)


def impute_by_cluster(
    df: DataFrame,
    spec: Mapping[str, object],
    k: int | Sequence[int] = 3,
    seed: int = 42,
    keep_groups: bool = False,
    min_rows: int = MIN_GROUP_ROWS,
    keys: Sequence[str] = (),
) -> DataFrame:
    """H8 with clusters: a Gaussian mixture on the NULL-free numeric columns
    assigns ``groups``; each NULL is then filled by its group's statistic
    (global for small groups).  Columns not in ``spec`` default to
    most_frequent, as in the reference.  ``keys`` are row ids and take no part
    in the clusters; of several ``k`` the one of least AIC is taken."""
    from pyspark.ml.clustering import GaussianMixture
    from pyspark.ml.feature import VectorAssembler

    full, with_nulls = null_columns(df)
    num = [c for c in full if c not in keys and isinstance(df.schema[c].dataType, NumericType)]
    vec = VectorAssembler(inputCols=num, outputCol="_f").transform(df)
    if not isinstance(k, int):
        from logweave.operators.cluster import gmm_select

        vec = cut_lineage(vec)
        model = gmm_select(vec, k, "_f", seed)[1].setPredictionCol("groups").setProbabilityCol("_p")
    else:
        model = GaussianMixture(k=k, featuresCol="_f", predictionCol="groups", probabilityCol="_p", seed=seed).fit(vec)
    grouped = model.transform(vec).drop("_f", "_p")
    full_spec = {c: spec.get(c, "most_frequent") for c in with_nulls}
    out = impute_by_group(grouped, "groups", full_spec, min_rows)
    return out if keep_groups else out.drop("groups")
