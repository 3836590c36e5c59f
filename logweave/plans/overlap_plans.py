"""Queries: train/test sets, overlap, set functions and overlap filters.

The lineitem log is used (100 suppliers x 1,500 customers at sf0.01) so that
common and uncommon sets are both non-trivial.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from logweave.operators import overlap as O
from logweave.plans import sqlgen as S
from logweave.plans.registry import query
from logweave.sources.fixtures import ids_lineitem, log_lineitem

IDS_LI = (
    "(SELECT DISTINCT 'f' || CAST(l_partkey AS VARCHAR) AS \"FileID\", "
    "CASE WHEN l_partkey % 10 < 7 THEN 'train' ELSE 'test' END AS split FROM lineitem)"
)
SPLIT_SQL = f'(SELECT l.*, i.split FROM {S.LOG_LINEITEM} l JOIN {IDS_LI} i USING ("FileID"))'


def _sets(spark, d):
    return O.train_test_sets(log_lineitem(spark, d), ids_lineitem(spark, d))


def _members(cols):
    return ", ".join(S.q(c) for c in cols)


def side_sql(cols, split):
    return f"SELECT DISTINCT {_members(cols)} FROM {SPLIT_SQL} WHERE split = '{split}'"


def common_sql(cols):
    return f"{side_sql(cols, 'train')} INTERSECT {side_sql(cols, 'test')}"


def uncommon_sql(cols):
    a, b = side_sql(cols, "train"), side_sql(cols, "test")
    return f"(({a}) EXCEPT ({b})) UNION ALL (({b}) EXCEPT ({a}))"


@query(
    "split_train_test",
    f'SELECT "FileID", "CustomerID", "QueryTs", "ProductID", split FROM {SPLIT_SQL}',
)
def split_train_test(spark, d):
    """Log rows of listed files tagged with their split."""
    return O.split_log(log_lineitem(spark, d), ids_lineitem(spark, d))


@query(
    "train_test_sets",
    f"SELECT DISTINCT split, 'product' AS kind, \"ProductID\", NULL::VARCHAR AS \"CustomerID\" FROM {SPLIT_SQL} "
    f"UNION ALL SELECT DISTINCT split, 'customer', NULL::VARCHAR, \"CustomerID\" FROM {SPLIT_SQL} "
    f"UNION ALL SELECT DISTINCT split, 'prod_cus', \"ProductID\", \"CustomerID\" FROM {SPLIT_SQL}",
)
def train_test_sets(spark, d):
    """Product, customer and per-product customer sets per split."""
    sets = _sets(spark, d)
    out = None
    for kind, t in sets.items():
        t = t.withColumn("kind", F.lit(kind))
        for c in ("ProductID", "CustomerID"):
            if c not in t.columns:
                t = t.withColumn(c, F.lit(None).cast("string"))
        t = t.select("split", "kind", "ProductID", "CustomerID")
        out = t if out is None else out.unionByName(t)
    return out


@query("distinct_ids", f"SELECT DISTINCT split, \"ProductID\" FROM {SPLIT_SQL}")
def distinct_ids(spark, d):
    """Distinct products per split."""
    return _sets(spark, d)["product"]


@query("customers_by_product", f"SELECT DISTINCT split, \"ProductID\", \"CustomerID\" FROM {SPLIT_SQL}")
def customers_by_product(spark, d):
    """Customers of each product per split, long (one row per member)."""
    return _sets(spark, d)["prod_cus"]


_NAMES = {"product": "products", "customer": "customers", "prod_cus": "pairs"}
for _kind, _cols in O.KINDS.items():

    def _mk(kind, cols):
        @query(f"common_{_NAMES[kind]}", common_sql(cols))
        def _common(spark, d):
            """Intersection of the train and test sets."""
            return O.overlap(_sets(spark, d), kind, reverse=False)

        sql = uncommon_sql(cols)
        if kind == "prod_cus":
            both = common_sql(["ProductID"])
            sql = f'SELECT * FROM ({sql}) WHERE "ProductID" IN ({both})'

        @query(f"uncommon_{_NAMES[kind]}", sql)
        def _uncommon(spark, d):
            """G5 reverse: symmetric difference (pairs: products on both sides only)."""
            return O.overlap(_sets(spark, d), kind, reverse=True)

    _mk(_kind, _cols)

PC = ["ProductID", "CustomerID"]


@query("set_union", f"{side_sql(PC, 'train')} UNION {side_sql(PC, 'test')}")
def set_union(spark, d):
    """G1: per product, union of train and test customer sets."""
    return O.per_product_sets(_sets(spark, d), "union")


@query("set_symdiff", uncommon_sql(PC))
def set_symdiff(spark, d):
    """Per product, symmetric difference (one-sided product -> its set)."""
    return O.per_product_sets(_sets(spark, d), "symdiff")


@query("set_intersect", common_sql(PC))
def set_intersect(spark, d):
    """Per product, intersection (one-sided product -> nothing)."""
    return O.per_product_sets(_sets(spark, d), "intersect")


@query(
    "overlap_train_test",
    f"SELECT 'product' AS kind, \"ProductID\", NULL::VARCHAR AS \"CustomerID\" FROM ({common_sql(['ProductID'])}) "
    f"UNION ALL SELECT 'customer', NULL::VARCHAR, \"CustomerID\" FROM ({common_sql(['CustomerID'])}) "
    f"UNION ALL SELECT 'prod_cus', \"ProductID\", \"CustomerID\" FROM ({common_sql(PC)})",
)
def overlap_train_test(spark, d):
    """All common sets from one pass over the log."""
    res = O.overlap_all(log_lineitem(spark, d), ids_lineitem(spark, d))
    out = None
    for kind, t in res.items():
        for c in ("ProductID", "CustomerID"):
            if c not in t.columns:
                t = t.withColumn(c, F.lit(None).cast("string"))
        t = t.select(F.lit(kind).alias("kind"), "ProductID", "CustomerID")
        out = t if out is None else out.unionByName(t)
    return out


def _filter_sql(typ):
    log = S.LOG_LINEITEM
    if typ == "tight":
        cond = f'("ProductID", "CustomerID") IN ({common_sql(PC)})'
    elif typ == "product":
        cond = f'"ProductID" IN ({common_sql(["ProductID"])})'
    elif typ == "customer":
        cond = f'"CustomerID" IN ({common_sql(["CustomerID"])})'
    else:
        cond = f'"ProductID" IN ({common_sql(["ProductID"])}) AND "CustomerID" IN ({common_sql(["CustomerID"])})'
    return f"SELECT * FROM {log} WHERE {cond}"


for _typ in ("tight", "loose", "product", "customer"):

    def _mk2(typ):
        @query(f"filter_{typ}", _filter_sql(typ))
        def _f(spark, d):
            """Log rows kept by the common-set filter of this type."""
            log = log_lineitem(spark, d)
            target = O.overlap_all(log, ids_lineitem(spark, d))
            return O.common_filter(log, target, typ)

    _mk2(_typ)


@query(
    "overlap_filtered_log",
    f"SELECT *, 'tight' AS typ FROM ({_filter_sql('tight')}) UNION ALL SELECT *, 'loose' FROM ({_filter_sql('loose')})",
)
def overlap_filtered_log(spark, d):
    """The whole log filtered by each overlap type (each from the original log)."""
    log = log_lineitem(spark, d)
    target = O.overlap_all(log, ids_lineitem(spark, d))
    return O.overlap_filtered_log(log, target)


@query(
    "breakout_common_customers",
    "SELECT DISTINCT \"CustomerID\" FROM " + S.batched(SPLIT_SQL, 7)
    + " WHERE batch_id < 1 AND split = 'train' INTERSECT SELECT DISTINCT \"CustomerID\" FROM "
    + S.batched(SPLIT_SQL, 7) + " WHERE batch_id < 1 AND split = 'test'",
)
def breakout_common_customers(spark, d):
    """customers common to train and test within the first 7-day batch only."""
    from logweave.operators.batches import assign_batches, first_batches

    log = first_batches(assign_batches(log_lineitem(spark, d), 7), 1)
    return O.overlap(O.train_test_sets(log, ids_lineitem(spark, d), ["customer"]), "customer")
