"""End-to-end jobs: the reference's daily / weekly / monthly exports, the
feature-table build and the per-split series dump, as Spark jobs.

    python -m logweave.plans.etl --log DIR --train CSV --test CSV --out DIR

reads headerless day files and id lists, writes every feature export as
parquet under ``out/<name>`` (names follow the reference's export files),
then assembles ``out/trend_v<version>``.  Day ranks come from the file
listing, so the log is not read just to find its days.
"""

from __future__ import annotations

import argparse
import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from logweave.functions.stats import F5, F11, widen
from logweave.operators import assemble as A
from logweave.operators import counts as C
from logweave.operators import tensors as T
from logweave.operators import tfidf as TF
from logweave.operators.batches import assign_batches
from logweave.operators.intervals import interval_features
from logweave.session import cut_lineage, get_session
from logweave.sources import sinks as SK
from logweave.sources.log import listed_days, read_id_list, read_query_log


def _write(df: DataFrame, out: str, name: str) -> str:
    path = os.path.join(out, name)
    SK.write_features(df, path)
    return path


def etl_daily(log: DataFrame, out: str, days: list | None = None) -> list[str]:
    """1-day batches: counts, distinct counts, daily counts, product detail (long:
    counts per batch and their statistics), hour histogram, day TF-IDF (the
    reference's 1-file run)."""
    b = assign_batches(log, 1, days=days)
    paths = [
        _write(C.fact_features(C.count_facts(b, "countCustomer"), "countCustomer"), out, "trend_cus_count"),
        _write(C.fact_features(C.count_facts(b, "countProduct"), "countProduct"), out, "trend_prod_count"),
        _write(
            C.fact_features(C.count_facts(b, "countProductCustomer"), "countProductCustomer"), out, "trend_prod_cus_count"
        ),
        _write(C.fact_features(C.daily_count_facts(b), "FileIDCountDaily"), out, "trend_fileid_count_daily"),
        _write(C.fact_features(C.uniq_facts(b, "uniqCustomer"), "uniqCustomer"), out, "trend_cus_nuniq"),
        _write(C.fact_features(C.uniq_facts(b, "uniqProduct"), "uniqProduct"), out, "trend_prod_nuniq"),
        _write(
            C.fact_features(C.uniq_facts(b, "uniqProductCustomer"), "uniqProductCustomer"), out, "trend_prod_cus_nuniq"
        ),
        _write(C.product_facts(b), out, "trend_prod_daily_raw"),
        _write(C.product_daily_stats(b), out, "trend_prod_daily"),
        _write(C.norm_percentage(C.hour_features(b)), out, "trend_hour_norm"),
        _write(TF.tfidf_summary(TF.corpus_by_batch(b), "day"), out, "trend_tfidf_day"),
    ]
    return paths


def etl_weekly(log: DataFrame, out: str, days: list | None = None) -> list[str]:
    """7-day batches: weekday histogram features (the reference's 7-file run)."""
    b = assign_batches(log, 7, days=days)
    return [_write(C.norm_percentage(C.week_features(b)), out, "trend_week_norm")]


def etl_monthly(log: DataFrame, out: str, days: list | None = None) -> list[str]:
    """31-day batches: intervals, product TF-IDF, deep counts (31-file run)."""
    b = assign_batches(log, 31, days=days)
    paths = [
        _write(interval_features(log), out, "trend_interval"),
        _write(interval_features(log, "CustomerID"), out, "trend_interval_customerid"),
        _write(interval_features(log, "ProductID"), out, "trend_interval_productid"),
        _write(interval_features(log, "ProductCustomerID"), out, "trend_interval_productcustomerid"),
        _write(TF.tfidf_summary(TF.corpus(log, "ProductID"), "ProductID"), out, "trend_tfidf_ProductID"),
    ]
    for field, name in (
        ("countCustomer", "trend_cus_count_deep"),
        ("countProduct", "trend_prod_count_deep"),
        ("countProductCustomer", "trend_prod_cus_count_deep"),
    ):
        paths.append(_write(C.fact_features(C.deep_counts(b, field), field, F11), out, name))
    for field, name in (
        ("uniqCustomer", "trend_cus_nuniq_deep"),
        ("uniqProduct", "trend_prod_nuniq_deep"),
        ("uniqProductCustomer", "trend_prod_cus_nuniq_deep"),
    ):
        paths.append(_write(C.fact_features(C.uniq_facts(b, field), field, F11), out, name))
    return paths


# Export tables joined into the feature table, and the
# separately filtered deep-count group.
FEATURE_EXPORTS = [
    "trend_interval", "trend_tfidf_ProductID", "trend_week_norm", "trend_hour_norm",
    "trend_fileid_count_daily", "trend_tfidf_day", "trend_interval_productid", "trend_interval_customerid",
]
DEEP_EXPORTS = ["trend_prod_count_deep", "trend_cus_count_deep", "trend_prod_cus_count_deep"]


def gen_feature_table(
    spark: SparkSession, out: str, version: int = 7, vari: bool = False, cori: bool = False, products: Sequence[str] = ()
) -> str:
    """K9: outer-join the exports, add range columns, filter, write ``trend_v<version>``.
    Statistics of the listed ``products`` become columns."""
    read = lambda n: spark.read.parquet(os.path.join(out, n))
    detail = [widen(read("trend_prod_daily"), "FileID", "ProductID", F5, products)] if products else []
    deep = A.filter_data(A.assemble([read(n) for n in DEEP_EXPORTS]), vari, cori)
    wide = cut_lineage(A.range_features(A.assemble([read(n) for n in FEATURE_EXPORTS] + detail + [deep])))
    return _write(A.filter_data(wide, vari, cori), out, f"trend_v{version}")


def dump_series(log: DataFrame, ids: DataFrame, out: str) -> str:
    """Per-second facts of listed files, written per split."""
    path = os.path.join(out, "series")
    SK.write_split_series(T.split_series(T.per_second_counts(log), ids), path)
    return path


def run(
    spark: SparkSession, log_dir: str, train: str, test: str, out: str, version: int = 7, products: Sequence[str] = ()
) -> str:
    """All exports, the feature table and the series dump for one log folder.

    The CSV log is parsed once, into a columnar copy under ``out`` of which each
    export reads the columns it needs."""
    days = listed_days(spark, log_dir)
    copy = os.path.join(out, "log")
    read_query_log(spark, log_dir).write.mode("overwrite").parquet(copy)
    log = spark.read.parquet(copy)
    ids = read_id_list(spark, train, "train").unionByName(read_id_list(spark, test, "test"))
    etl_daily(log, out, days)
    etl_weekly(log, out, days)
    etl_monthly(log, out, days)
    dump_series(log, ids, out)
    return gen_feature_table(spark, out, version, products=products)


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.split("\n\n")[0])
    ap.add_argument("--log", required=True, help="folder of headerless day files")
    ap.add_argument("--train", required=True, help="training id list (FileID, y)")
    ap.add_argument("--test", required=True, help="testing id list")
    ap.add_argument("--out", required=True, help="output folder (shared storage)")
    ap.add_argument("--version", type=int, default=7)
    ap.add_argument("--products", nargs="*", default=(), help="products that become columns of the feature table")
    a = ap.parse_args(argv)
    spark = get_session("logweave-etl")
    print(run(spark, a.log, a.train, a.test, a.out, a.version, a.products))


if __name__ == "__main__":
    main()
