"""Queries: tabular preparation, feature selection and feature-table assembly."""

from __future__ import annotations

from pyspark.sql import functions as F

from logweave.functions.stats import F11, F12
from logweave.operators import assemble as A
from logweave.operators import prep as P
from logweave.operators import select as SEL
from logweave.operators.counts import count_facts, daily_count_facts, fact_features
from logweave.operators.batches import assign_batches
from logweave.operators.intervals import interval_features, interval_name
from logweave.plans import sqlgen as S
from logweave.plans.intervals_plans import _lag_sql
from logweave.plans.registry import query
from logweave.plans.tabular import prepare
from logweave.sources.fixtures import (
    PART_TYPE_GRADES,
    ids_events,
    lineitem_calendar,
    log_events,
    table,
    tabular_customer,
    tabular_part,
)

TP = (
    "(SELECT p_partkey, p_name, CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE p_brand END AS p_brand, "
    "p_type, CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE p_size END AS p_size, p_retailprice FROM part)"
)
TC = (
    "(SELECT c_custkey, c_name, c_nationkey, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_acctbal END AS c_acctbal, "
    "c_mktsegment FROM customer)"
)
PART_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


@query("drop_columns", f"SELECT p_partkey, p_brand, p_type, p_size, p_retailprice FROM {TP}")
def drop_columns(spark, d):
    """Drop listed columns (absent names ignored)."""
    return P.drop_columns(tabular_part(spark, d), ["p_name", "no_such_column"])


@query(
    "null_profile",
    "SELECT * FROM ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {S.rnd(f'avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END)')} AS null_ratio FROM {TP}"
        for c in ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"]
    )
    + ") WHERE null_ratio > 0",
)
def null_profile(spark, d):
    """Share of NULLs per column holding any."""
    return P.null_profile(tabular_part(spark, d))


@query(
    "drop_constant",
    'SELECT "FileID", "QueryTs", CAST(isodow(make_timestamp("QueryTs" * 1000000)) - 1 AS INTEGER) AS weekday '
    f"FROM {S.LOG_LINEITEM}",
)
def drop_constant(spark, d):
    """The hour column of a day-granular log holds one value and is dropped."""
    return P.drop_constant(lineitem_calendar(spark, d))


@query(
    "ordinal_map",
    "SELECT p_partkey, CAST(CASE p_type "
    + " ".join(f"WHEN '{k}' THEN {v}" for k, v in PART_TYPE_GRADES.items())
    + f" ELSE 0 END AS INTEGER) AS p_type FROM {TP}",
)
def ordinal_map(spark, d):
    """H3: p_type through a grade map, unmapped -> 0."""
    return P.ordinal_map(tabular_part(spark, d).select("p_partkey", "p_type"), {"p_type": PART_TYPE_GRADES})


def _le_sql(c):
    return (
        f"(SELECT v, CAST(dense_rank() OVER (ORDER BY v) - 1 AS INTEGER) AS code FROM "
        f"(SELECT DISTINCT coalesce({c}, 'nan') AS v FROM {TP}))"
    )


@query(
    "label_encode",
    f"SELECT t.p_partkey, b.code AS p_brand, y.code AS p_type, t.p_size FROM {TP} t "
    f"LEFT JOIN {_le_sql('p_brand')} b ON t.p_brand = b.v LEFT JOIN {_le_sql('p_type')} y ON t.p_type = y.v",
)
def label_encode(spark, d):
    """H4: strings -> sorted-level codes ('nan' ranks among levels when NULLs exist)."""
    df = tabular_part(spark, d).select("p_partkey", "p_brand", "p_type", "p_size")
    return P.label_encode(df, ["p_brand", "p_type", "p_size"])


TYPE_GRADES = {"ECONOMY": 1, "PROMO": 2, "LARGE": 3}
_CODED = (
    f"(SELECT t.p_partkey, b.code AS p_brand, t.p_size, t.p_retailprice, CASE t.p_type "
    + " ".join(f"WHEN '{k}' THEN {v}" for k, v in TYPE_GRADES.items())
    + f" ELSE 0 END AS p_type FROM {TP} t LEFT JOIN {_le_sql('p_brand')} b ON t.p_brand = b.v)"
)


@query(
    "tabular_prepared",
    f"SELECT p_partkey, p_type, coalesce(p_brand, (SELECT p_brand FROM {_CODED} WHERE p_brand IS NOT NULL "
    "GROUP BY p_brand ORDER BY count(*) DESC, p_brand LIMIT 1)) AS p_brand, "
    f"coalesce(cast(p_size AS DOUBLE), (SELECT median(p_size) FROM {TP})) AS p_size, p_retailprice, "
    f"CASE WHEN p_partkey % 3 = 0 THEN 'test' ELSE 'train' END AS part FROM {_CODED}",
)
def tabular_prepared(spark, d):
    """Part in two parts, prepared together: a column dropped,
    types graded, brands coded, sizes filled by median and brands by mode."""
    df = tabular_part(spark, d)
    test = df.where("p_partkey % 3 = 0")
    return prepare(
        df.where("p_partkey % 3 <> 0"), test, "p_partkey", useless=["p_name"], grades={"p_type": TYPE_GRADES}, impute={"p_size": "median"}
    )


@query(
    "one_hot",
    "SELECT p_partkey, "
    + ", ".join(f"CAST(p_type = '{v}' AS INTEGER) AS \"p_type_{v}\"" for v in PART_TYPES[1:])
    + f" FROM {TP}",
)
def one_hot(spark, d):
    """H5: dummies of a NULL-free column (first level dropped)."""
    return P.one_hot(tabular_part(spark, d).select("p_partkey", "p_type"), ["p_type"])


@query(
    "one_hot_nulls",
    "SELECT p_partkey, "
    + ", ".join(f"CAST(coalesce(p_brand = 'Brand#{i}', false) AS INTEGER) AS \"p_brand_Brand#{i}\"" for i in range(1, 26))
    + f" FROM {TP}",
)
def one_hot_nulls(spark, d):
    """H5: dummies of a column with NULLs (all levels kept, NULL row all 0)."""
    return P.one_hot(tabular_part(spark, d).select("p_partkey", "p_brand"), ["p_brand"])


_BRANDS = f"SELECT p_partkey, 'p_brand' AS \"column\", p_brand AS level FROM {TP} WHERE p_brand IS NOT NULL"


@query(
    "one_hot_long",
    f"{_BRANDS} UNION ALL SELECT p_partkey, 'p_type', p_type FROM {TP} WHERE p_type > (SELECT min(p_type) FROM {TP}) "
    f"UNION ALL SELECT p_partkey, 'p_name', p_name FROM {TP} WHERE p_name > (SELECT min(p_name) FROM {TP})",
)
def one_hot_long(spark, d):
    """H5 for any number of levels: the ones of the dummies of brand (with NULLs), type
    and name (nearly as many levels as rows)."""
    return P.one_hot_long(tabular_part(spark, d), ["p_partkey"], ["p_brand", "p_type", "p_name"])


_MODE_BRAND = (
    f"(SELECT p_brand FROM {TP} WHERE p_brand IS NOT NULL GROUP BY p_brand ORDER BY count(*) DESC, p_brand LIMIT 1)"
)


@query(
    "impute_simple",
    f"SELECT p_partkey, coalesce(p_brand, {_MODE_BRAND}) AS p_brand, "
    f"{S.rnd(f'coalesce(CAST(p_size AS DOUBLE), (SELECT median(p_size) FROM {TP}))')} AS p_size, "
    f"{S.rnd(f'coalesce(p_retailprice, (SELECT avg(p_retailprice) FROM {TP}))')} AS p_retailprice FROM {TP}",
)
def impute_simple(spark, d):
    """H6: mode / median / mean fills."""
    df = tabular_part(spark, d).select("p_partkey", "p_brand", "p_size", "p_retailprice")
    return P.impute_simple(df, {"p_brand": "most_frequent", "p_size": "median", "p_retailprice": "mean"})


@query(
    "impute_by_group",
    f"SELECT c_custkey, c_mktsegment, {S.rnd('coalesce(CAST(c_acctbal AS DOUBLE), CASE WHEN g.n >= 5 THEN coalesce(g.med, a.med) ELSE a.med END)')} AS c_acctbal "
    f"FROM {TC} t JOIN (SELECT c_mktsegment, count(*) AS n, median(c_acctbal) AS med FROM {TC} GROUP BY 1) g USING (c_mktsegment), "
    f"(SELECT median(c_acctbal) AS med FROM {TC}) a",
)
def impute_by_group(spark, d):
    """H8: c_acctbal filled by the median of its market segment (global if < 5 rows)."""
    df = tabular_customer(spark, d).select("c_custkey", "c_mktsegment", "c_acctbal")
    return P.impute_by_group(df, "c_mktsegment", {"c_acctbal": "median"})


def _fill_policy_sql():
    feat = S.stats_sql(f"({_lag_sql('ProductCustomerID')})", ["FileID"], "QueryTsIntervalProductCustomerID", F12,
                       name=lambda s: interval_name(s, "ProductCustomerID"))
    cols = []
    for s in F12:
        n = interval_name(s, "ProductCustomerID")
        zero = any(k in n.lower() for k in ("std", "skew", "mad"))
        cols.append(f"coalesce(f.{S.q(n)}, {0 if zero else -1}) AS {S.q(n)}")
    return f'SELECT i."FileID", i.y, {", ".join(cols)} FROM {S.IDS_EVENTS} i LEFT JOIN ({feat}) f USING ("FileID")'


@query("fill_policy", _fill_policy_sql())
def fill_policy(spark, d):
    """H9: all listed files x interval features; interval std/skew/mad NULL -> 0, rest -> -1."""
    feats = interval_features(log_events(spark, d), "ProductCustomerID")
    ids = ids_events(spark, d).select("FileID", "y")
    return P.fill_policy(ids.join(feats, "FileID", "left"))


@query(
    "combine_period",
    "SELECT o_orderkey, CAST(year(o_orderdate) AS VARCHAR) || CAST(quarter(o_orderdate) AS VARCHAR) AS \"YQSold\", "
    "CAST(year(o_orderdate) AS VARCHAR) || CAST(month(o_orderdate) AS VARCHAR) AS \"YMSold\" FROM orders",
)
def combine_period(spark, d):
    """H2: year+quarter and year+month keys."""
    o = table(spark, d, "orders").select(
        "o_orderkey", F.year("o_orderdate").alias("y"), F.month("o_orderdate").alias("m")
    )
    o = o.withColumn("y2", F.col("y")).withColumn("m2", F.col("m"))
    o = P.combine_period(o, "y", "m", by="q")
    return P.combine_period(o, "y2", "m2", by="m")


# ---------------------------------------------------------------- selection
def _interval_feats(spark, d):
    return interval_features(log_events(spark, d))


_IV_SQL = S.stats_sql(f"({_lag_sql('')})", ["FileID"], "QueryTsInterval", F12, name=lambda s: interval_name(s, ""))
_IV_COLS = [interval_name(s, "") for s in F12]
_IV_RAW = S.stats_sql(f"({_lag_sql('')})", ["FileID"], "QueryTsInterval", F12, name=lambda s: interval_name(s, ""), raw=True)


@query(
    "standardize",
    f'SELECT "FileID", '
    + ", ".join(
        f"{S.rnd(f'({S.q(c)} - avg({S.q(c)}) OVER ()) / CASE WHEN coalesce(stddev_pop({S.q(c)}) OVER (), 0) = 0 THEN 1 ELSE stddev_pop({S.q(c)}) OVER () END')} AS {S.q(c)}"
        for c in _IV_COLS
    )
    + f" FROM ({_IV_RAW})",
)
def standardize(spark, d):
    """K8: z-score every interval feature (population std, zero std -> / 1)."""
    return SEL.standardize(_interval_feats(spark, d), key="FileID")


@query(
    "variance_profile",
    " UNION ALL ".join(f"SELECT '{c}' AS \"column\", {S.rnd(f'var_pop({S.q(c)})')} AS variance FROM ({_IV_RAW})" for c in _IV_COLS),
)
def variance_profile(spark, d):
    """K7 statistics: population variance of every interval feature."""
    df = _interval_feats(spark, d)
    return SEL.variances(df, SEL.numeric_columns(df, ["FileID"]))


_IV_INTS = {interval_name(s, "") for s in S.INT_STATS}
_KEPT = ", ".join(f"{S.q(c) if c in _IV_INTS else S.rnd(S.q(c))} AS {S.q(c)}" for c in _IV_COLS)


# In the test tables every column varies by more than that, so all stay.
@query("variance_filter", f'SELECT "FileID", {_KEPT} FROM ({_IV_RAW})')
def variance_filter(spark, d):
    """K7: drop features whose raw population variance is at most 0.16."""
    return SEL.variance_filter(_interval_feats(spark, d), threshold=0.16, standardized=False)


def _pairs_sql():
    parts = []
    for i, a in enumerate(_IV_COLS):
        for b in _IV_COLS[:i]:
            parts.append(f"SELECT '{a}' AS col_i, '{b}' AS col_j, {S.rnd(f'corr({S.q(a)}, {S.q(b)})')} AS corr FROM ({_IV_RAW})")
    return " UNION ALL ".join(parts)


@query("corr_pairs", _pairs_sql())
def corr_pairs(spark, d):
    """K5/K6 statistics: pairwise Pearson correlation of the interval features."""
    df = _interval_feats(spark, d)
    return SEL.correlation_pairs(df, SEL.numeric_columns(df, ["FileID"]))


@query(
    "low_corr",
    "SELECT DISTINCT col_i AS \"column\" FROM (" + _pairs_sql() + ") WHERE corr >= 0.95",
)
def low_corr(spark, d):
    """K5: columns dropped by the low-correlation filter (threshold 0.95)."""
    df = _interval_feats(spark, d)
    return SEL.low_corr_drop(SEL.correlation_pairs(df, SEL.numeric_columns(df, ["FileID"])), 0.95)


def _groups_sql(threshold):
    """The greedy rule column by column: a list of covered columns and one of those to
    remove, carried from column to column."""
    raw = " UNION ALL ".join(
        f"SELECT {i} AS i, {j} AS j, corr({S.q(a)}, {S.q(b)}) AS corr FROM f" for i, a in enumerate(_IV_COLS) for j, b in enumerate(_IV_COLS[:i])
    )
    return f"""
    WITH RECURSIVE f AS MATERIALIZED ({_IV_RAW}), pairs AS ({raw}),
    later AS (SELECT j, list(i ORDER BY i) AS p FROM pairs WHERE corr > {threshold} GROUP BY j),
    step AS (SELECT k AS j, coalesce(p, []) AS p FROM range({len(_IV_COLS)}) t(k) LEFT JOIN later ON later.j = k),
    walk AS (
        SELECT 0::BIGINT AS j, []::BIGINT[] AS covered, []::BIGINT[] AS removed
        UNION ALL
        SELECT walk.j + 1,
            CASE WHEN len(p) > 0 AND NOT list_contains(covered, walk.j) THEN list_concat(covered, p) ELSE covered END,
            CASE WHEN len(p) > 0 AND NOT list_contains(covered, walk.j) THEN list_concat(removed, list_append(p, walk.j)[2:]) ELSE removed END
        FROM walk JOIN step ON step.j = walk.j)
    SELECT CAST(pos - 1 AS INTEGER) AS pos, ([{", ".join(f"'{c}'" for c in _IV_COLS)}])[c + 1] AS "column"
    FROM (SELECT unnest(removed) AS c, generate_subscripts(removed, 1) AS pos FROM walk WHERE j = {len(_IV_COLS)})
    """


@query("corr_groups", _groups_sql(0.95))
def corr_groups(spark, d):
    """K6: greedy correlated-group removal list (threshold 0.95)."""
    df = _interval_feats(spark, d)
    cols = SEL.numeric_columns(df, ["FileID"])
    pairs = [tuple(r) for r in SEL.correlation_pairs(df, cols).collect()]
    out = SEL.correlation_groups(pairs, cols, 0.95)
    return spark.createDataFrame([(i, c) for i, c in enumerate(out)], "pos int, column string")


# ---------------------------------------------------------------- assembly
def _daily_sql():
    return (
        f'SELECT batch_id, "FileID", count(*) AS "FileIDCountDaily" FROM {S.batched(S.LOG_EVENTS, 1)} GROUP BY ALL'
    )


def _assemble_sql():
    daily = S.stats_sql(f"({_daily_sql()})", ["FileID"], "FileIDCountDaily", F11, name=lambda s: f"FileIDCountDaily_{s}")
    iv = _IV_SQL
    cnt = (
        f'SELECT batch_id, "FileID", "CustomerID", count(*) AS "countCustomer" FROM {S.batched(S.LOG_EVENTS, 1)} GROUP BY ALL'
    )
    cus = S.stats_sql(f"({cnt})", ["FileID"], "countCustomer", F11, name=lambda s: f"countCustomer_{s}")
    return (
        f'SELECT coalesce(a."FileID", b."FileID", c."FileID") AS "FileID", a.* EXCLUDE ("FileID"), '
        f'b.* EXCLUDE ("FileID"), c.* EXCLUDE ("FileID") FROM ({iv}) a '
        f'FULL OUTER JOIN ({daily}) b ON a."FileID" = b."FileID" '
        f'FULL OUTER JOIN ({cus}) c ON coalesce(a."FileID", b."FileID") = c."FileID"'
    )


def _assembled(spark, d):
    log = log_events(spark, d)
    b1 = assign_batches(log, 1)
    return A.assemble(
        [
            interval_features(log),
            fact_features(daily_count_facts(b1), "FileIDCountDaily"),
            fact_features(count_facts(b1, "countCustomer"), "countCustomer"),
        ]
    )


@query("assemble_features", _assemble_sql())
def assemble_features(spark, d):
    """Interval, daily-count and customer-count features outer-joined on FileID."""
    return _assembled(spark, d)


@query(
    "range_features",
    f"SELECT *, {S.rnd('\"QueryTsIntervalMax\" - \"QueryTsIntervalMin\"')} AS \"QueryTsIntervalRange\" FROM ({_IV_SQL})",
)
def range_features(spark, d):
    """Max - min range columns next to each max/min pair."""
    return A.range_features(_interval_feats(spark, d))


@query(
    "get_train",
    f'SELECT i."FileID", i.y, f.* EXCLUDE ("FileID") FROM {S.IDS_EVENTS} i LEFT JOIN ({_IV_SQL}) f USING ("FileID") '
    "WHERE i.split = 'train'",
)
def get_train(spark, d):
    """Training ids with label, left-joined to features."""
    return A.attach_labels(_interval_feats(spark, d), ids_events(spark, d), "train")


@query(
    "get_test",
    f'SELECT i."FileID", f.* EXCLUDE ("FileID") FROM {S.IDS_EVENTS} i LEFT JOIN ({_IV_SQL}) f USING ("FileID") '
    "WHERE i.split = 'test'",
)
def get_test(spark, d):
    """Testing ids left-joined to features (no label)."""
    return A.attach_labels(_interval_feats(spark, d), ids_events(spark, d), "test")


@query("impute_by_cluster")
def impute_by_cluster(spark, d):
    """H8: GMM groups (2 to 4, by AIC) on the NULL-free numeric part columns but the
    key; p_size by group median, p_brand by group mode."""
    df = tabular_part(spark, d).select("p_partkey", "p_retailprice", "p_size", "p_brand")
    return P.impute_by_cluster(df, {"p_size": "median"}, k=(2, 3, 4), keep_groups=True, keys=("p_partkey",))


@query(
    "union_train_test",
    f"SELECT p_partkey, p_type, p_size, p_retailprice, 'train' AS split FROM {TP} WHERE p_partkey % 10 < 7 "
    f"UNION ALL SELECT p_partkey, p_type, p_size, NULL::DOUBLE, 'test' FROM {TP} WHERE p_partkey % 10 >= 7",
)
def union_train_test(spark, d):
    """Train and test tables (test without the target) stacked with a
    split column, missing target NULL."""
    from logweave.sources.log import union_train_test as U

    p = tabular_part(spark, d).select("p_partkey", "p_type", "p_size", "p_retailprice")
    return U(p.where(F.col("p_partkey") % 10 < 7), p.where(F.col("p_partkey") % 10 >= 7).drop("p_retailprice"))
