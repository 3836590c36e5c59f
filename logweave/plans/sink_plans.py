"""Queries: readers and writers round-tripped, and the full feature table."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from logweave.operators import assemble as A
from logweave.operators import counts as C
from logweave.operators import overlap as O
from logweave.operators import tensors as T
from logweave.operators import tfidf as TF
from logweave.operators.batches import assign_batches
from logweave.operators.intervals import interval_features
from logweave.plans import intervals_plans, sqlgen as S, tfidf_plans  # noqa: F401 (their SQL is used)
from logweave.plans.counts_plans import PRODUCTS
from logweave.plans.overlap_plans import SPLIT_SQL
from logweave.plans.prep_plans import _IV_SQL
from logweave.plans.registry import ORACLE, query
from logweave.plans.tensor_plans import sec_sql
from logweave.session import cut_lineage
from logweave.sources import sinks as SK
from logweave.sources.fixtures import ids_events, ids_lineitem, log_events, log_lineitem
from logweave.sources.log import read_feature_table, read_id_list, read_query_log, read_tabular, union_train_test
from logweave.streaming import incremental as I


@query(
    "scan_day_files",
    f'SELECT "FileID", "CustomerID", "QueryTs", "ProductID", CAST(floor("QueryTs" / 86400) AS BIGINT) AS day '
    f"FROM {S.LOG_EVENTS}",
)
def scan_day_files(spark, d):
    """A1/A2/A4: the events log written as headerless CSV day files and read
    back with the log reader (explicit schema, day from the file layout)."""
    base = I.scratch(spark, "dayfiles")
    log = log_events(spark, d).withColumn("day", F.floor(F.col("QueryTs") / 86400).cast("long"))
    log.hint("rebalance", "day").write.mode("overwrite").partitionBy("day").option("header", False).csv(base)
    back = read_query_log(spark, base)
    return back.select("FileID", "CustomerID", "QueryTs", "ProductID", F.col("day").cast("long"))


@query("sink_features", _IV_SQL)
def sink_features(spark, d):
    """Interval features written as parquet and read back."""
    path = I.scratch(spark, "features")
    SK.write_features(interval_features(log_events(spark, d)), path)
    return spark.read.parquet(path)


_SPLIT_EV = f'(SELECT l.*, i.split FROM {S.LOG_EVENTS} l JOIN {S.IDS_EVENTS} i USING ("FileID"))'


def _common_ev(cols):
    c = ", ".join(S.q(x) for x in cols)
    return (
        f"SELECT DISTINCT {c} FROM {_SPLIT_EV} WHERE split = 'train' INTERSECT "
        f"SELECT DISTINCT {c} FROM {_SPLIT_EV} WHERE split = 'test'"
    )


_INTERSECT_SQL = (
    f"SELECT *, 'tight' AS typ, CAST(floor(\"QueryTs\" / 86400) AS BIGINT) AS day FROM {S.LOG_EVENTS} "
    f"WHERE (\"ProductID\", \"CustomerID\") IN ({_common_ev(['ProductID', 'CustomerID'])}) UNION ALL "
    f"SELECT *, 'loose', CAST(floor(\"QueryTs\" / 86400) AS BIGINT) FROM {S.LOG_EVENTS} "
    f"WHERE \"ProductID\" IN ({_common_ev(['ProductID'])}) AND \"CustomerID\" IN ({_common_ev(['CustomerID'])})"
)


@query("sink_intersect", _INTERSECT_SQL)
def sink_intersect(spark, d):
    """The overlap-filtered events log written by type and day, read back."""
    log = log_events(spark, d)
    target = O.overlap_all(log, ids_events(spark, d))
    f = O.overlap_filtered_log(log, target).withColumn("day", F.floor(F.col("QueryTs") / 86400).cast("long"))
    path = I.scratch(spark, "intersect")
    SK.write_filtered_log(f, path)
    return spark.read.schema("FileID string, CustomerID string, QueryTs long, ProductID string, typ string, day long").csv(path)


@query("sink_split_series", f'SELECT s.*, i.split FROM ({sec_sql()}) s JOIN {S.IDS_EVENTS} i USING ("FileID")')
def sink_split_series(spark, d):
    """A10: per-second facts written per split (sorted by file), read back."""
    path = I.scratch(spark, "series")
    SK.write_split_series(T.split_series(T.per_second_counts(log_events(spark, d)), ids_events(spark, d)), path)
    return spark.read.parquet(path)


@query(
    "sink_blocks",
    f'SELECT count(*) AS rows, true AS capped FROM (SELECT DISTINCT "FileID", "QueryTs" FROM {S.LOG_EVENTS})',
)
def sink_blocks(spark, d):
    """Streamed per-second facts appended in blocks of <= 10,000 rows (a
    second belongs to one day, hence to one epoch): rows written, and whether
    every file kept to the block size."""
    out = I.stream_into(
        spark,
        "blocks",
        log_events(spark, d),
        lambda s, o, c: I.run(
            s.writeStream.foreachBatch(lambda b, e: SK.write_blocks(T.per_second_counts(b), o, e)), c
        ),
        files_per_trigger=10,
    )
    files = spark.read.parquet(out).groupBy(F.input_file_name().alias("file")).agg(F.count(F.lit(1)).alias("n"))
    return files.agg(F.sum("n").alias("rows"), (F.max("n") <= SK.BLOCK_ROWS).alias("capped"))


@query(
    "rows_to_records",
    "SELECT to_json({'FileID': \"FileID\", 'QueryTs': \"QueryTs\", 'CustomerIDCount': \"CustomerIDCount\", "
    "'ProductIDCount': \"ProductIDCount\", 'CustomerIDUniqCount': \"CustomerIDUniqCount\", "
    "'ProductIDUniqCount': \"ProductIDUniqCount\"}) AS record FROM ("
    'SELECT "FileID", "QueryTs", count("CustomerID") AS "CustomerIDCount", count("ProductID") AS "ProductIDCount", '
    'count(DISTINCT "CustomerID") AS "CustomerIDUniqCount", count(DISTINCT "ProductID") AS "ProductIDUniqCount" '
    f"FROM {S.LOG_EVENTS} GROUP BY ALL)",
)
def rows_to_records(spark, d):
    """Per-second facts as JSON records."""
    return SK.rows_to_records(T.per_second_counts(log_events(spark, d)))


@query(
    "persist_sets",
    f"SELECT split, count(*) AS count, 'product' AS kind FROM (SELECT DISTINCT split, \"ProductID\" FROM {SPLIT_SQL}) GROUP BY split "
    f"UNION ALL SELECT split, count(*), 'customer' FROM (SELECT DISTINCT split, \"CustomerID\" FROM {SPLIT_SQL}) GROUP BY split "
    f"UNION ALL SELECT split, count(*), 'prod_cus' FROM (SELECT DISTINCT split, \"ProductID\", \"CustomerID\" FROM {SPLIT_SQL}) GROUP BY split",
)
def persist_sets(spark, d):
    """train/test sets written as parquet, read back (kind, rows)."""
    sets = O.train_test_sets(log_lineitem(spark, d), ids_lineitem(spark, d))
    path = I.scratch(spark, "sets")
    SK.write_sets(sets, path)
    out = None
    for k in sets:
        t = spark.read.parquet(os.path.join(path, k)).groupBy("split").count().withColumn("kind", F.lit(k))
        out = t if out is None else out.unionByName(t)
    return out


def feature_table(spark, d, vari=False, cori=False):
    """K9: the versioned feature table of the reference's assembly step."""
    log = log_events(spark, d)
    b1, b7 = (assign_batches(log, n) for n in (1, 7))
    hour = C.norm_percentage(C.hour_features(b1))
    week = C.norm_percentage(C.week_features(b7))
    tables = [
        interval_features(log),
        C.product_daily_features(b1, PRODUCTS),
        TF.tfidf_summary(TF.corpus(log, "ProductID"), "ProductID"),
        week,
        hour,
        C.fact_features(C.daily_count_facts(b1), "FileIDCountDaily"),
        TF.tfidf_summary(TF.corpus_by_batch(b1), "day"),
        interval_features(log, "ProductID"),
        interval_features(log, "CustomerID"),
    ]
    deep = A.assemble(
        [
            C.fact_features(C.deep_counts(log, f), f)
            for f in ("countProduct", "countCustomer", "countProductCustomer")
        ]
    )
    # The filters run actions (column statistics) before returning a plan;
    # cut the lineage first so the wide table is computed once.
    tables.append(A.filter_data(cut_lineage(deep), vari, cori))
    wide = cut_lineage(A.range_features(A.assemble(tables)))
    return A.filter_data(wide, vari, cori)


_V7 = (
    "feat_interval", "feat_prod_daily", "tfidf_product", "feat_week", "feat_hour", "feat_file_daily", "tfidf_day",
    "feat_interval_product", "feat_interval_customer", "feat_prod_count_deep", "feat_cus_count_deep", "feat_prod_cus_count_deep",
)


def _v7_sql():
    """The component queries' SQL joined on the file; the columns that are constant in
    the test tables (sf0.01) are listed."""
    quarters = ("min", "median", "percentile_25")
    constant = ["ProductID_idf", "FileIDCountDaily_min", "hour15_percentile_75", "hour21_percentile_75", "countProduct_size"]
    constant += [f"hour{h}_{q}" for h in range(24) for q in quarters]
    constant += [f"{c}_{q}" for c in ("countCustomer", "countProductCustomer") for q in quarters] + ["countProductCustomer_percentile_75"]
    both = [f"hour{h}" for h in range(24)] + [f"week{w}" for w in range(7)] + ["FileIDCountDaily", "countProduct"]
    ranges = [(f"{c}_max", f"{c}_min", f"{c}_range") for c in both]
    ranges += [(f"QueryTsIntervalMax{f}", f"QueryTsIntervalMin{f}", f"QueryTsIntervalRange{f}") for f in ("", "ProductID", "CustomerID")]
    own = ", ".join(f"t{i} AS ({ORACLE[n]})" for i, n in enumerate(_V7))
    files = " UNION ".join(f'SELECT "FileID" FROM t{i}' for i in range(len(_V7)))
    joins = " ".join(f'LEFT JOIN t{i} USING ("FileID")' for i in range(len(_V7)))
    made = ", ".join(f"{S.rnd(f'{S.q(a)} - {S.q(b)}')} AS {S.q(c)}" for a, b, c in ranges)
    made += "".join(f', {S.q(f"{c}_ptp")} AS {S.q(f"{c}_range")}' for c in ("ProductID_tfidf", "day_tfidf"))  # unrounded differences
    return f"WITH {own} SELECT * EXCLUDE ({', '.join(map(S.q, constant))}), {made} FROM ({files}) {joins}"


@query("feature_table_v7", _v7_sql())
def feature_table_v7(spark, d):
    """K9: outer-joined feature tables + range columns, constant and
    percentage columns dropped (variance / correlation filters off)."""
    return feature_table(spark, d)




_EVENT_COUNTS = f'SELECT "FileID", count(*) AS n, max("QueryTs") AS last FROM {S.LOG_EVENTS} GROUP BY 1'


@query("read_feature_table", f"SELECT *, 'csv' AS fmt FROM ({_EVENT_COUNTS}) UNION ALL SELECT *, 'parquet' FROM ({_EVENT_COUNTS})")
def read_feature_table_query(spark, d):
    """A feature table written in both formats and read with the table reader."""
    counts = log_events(spark, d).groupBy("FileID").agg(F.count(F.lit(1)).alias("n"), F.max("QueryTs").alias("last"))
    out = None
    for fmt in ("csv", "parquet"):
        path = I.scratch(spark, f"table-{fmt}")
        SK.write_features(counts, path, fmt)
        t = read_feature_table(spark, path, fmt).select("FileID", F.col("n").cast("long"), F.col("last").cast("long"), F.lit(fmt).alias("fmt"))
        out = t if out is None else out.unionByName(t)
    return out


@query(
    "read_id_lists",
    f"SELECT \"FileID\", CASE WHEN split = 'train' THEN y END AS y, split FROM {S.IDS_EVENTS} UNION ALL SELECT 'none', NULL, 'empty' WHERE false",
)
def read_id_lists(spark, d):
    """A4/A5: headerless training and testing lists (the latter's second column is
    ignored), and an empty one, written and read back."""
    ids = ids_events(spark, d)
    base, out = I.scratch(spark, "ids"), None
    for split, rows in (("train", ids.where("split = 'train'")), ("test", ids.where("split = 'test'")), ("empty", ids.limit(0))):
        rows.select("FileID", "y").write.option("header", False).csv(f"{base}/{split}")
        t = read_id_list(spark, f"{base}/{split}", split)
        out = t if out is None else out.unionByName(t)
    return out


@query(
    "read_tabular",
    "SELECT c_custkey, c_name, c_nationkey, CASE WHEN c_custkey % 10 < 7 THEN c_acctbal END AS c_acctbal, "
    "CASE WHEN c_custkey % 10 < 7 THEN 'train' ELSE 'test' END AS split FROM customer",
)
def read_tabular_query(spark, d):
    """Header CSVs of both parts read by schema, the test one without its target,
    and stacked."""
    rows = spark.read.parquet(f"{d}/customer.parquet").select("c_custkey", "c_name", "c_nationkey", F.col("c_acctbal").cast("double"))
    base, ddl = I.scratch(spark, "tabular"), "c_custkey long, c_name string, c_nationkey long"
    train = F.col("c_custkey") % 10 < 7
    rows.where(train).write.option("header", True).csv(f"{base}/train")
    rows.where(~train).drop("c_acctbal").write.option("header", True).csv(f"{base}/test")
    return union_train_test(read_tabular(spark, f"{base}/train", f"{ddl}, c_acctbal double"), read_tabular(spark, f"{base}/test", ddl))


@query(
    "class_weights",
    f"SELECT y, count(*) AS n, CASE WHEN y = 1 THEN 8.0 ELSE 1.0 END * count(*) AS weight FROM {S.IDS_EVENTS} GROUP BY y",
)
def class_weights(spark, d):
    """Rows and total weight of each class."""
    from logweave.operators.models import with_weights

    return with_weights(ids_events(spark, d)).groupBy("y").agg(F.count(F.lit(1)).alias("n"), F.sum("w").alias("weight"))
