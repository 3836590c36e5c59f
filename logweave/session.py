"""Session construction and lineage-cutting helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every logweave job wants.  Hour / weekday features are computed
# from epoch arithmetic (UTC) so results do not depend on the session zone,
# but we still pin it for readable timestamps.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # ~128 MB shuffle partitions after AQE coalescing; 256 MB scan splits.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}

# Upper bound on one shuffle partition before AQE coalescing (spill-aware).
TARGET_PARTITION_BYTES = 200 * 1024 * 1024


def shuffle_partitions_for(input_bytes: int, target: int = TARGET_PARTITION_BYTES) -> int:
    """Initial shuffle partitions so a partition of the widest shuffle stays
    around ``target`` bytes; AQE coalesces the small ones at run time.
    100 TB -> ~500k partitions; never fewer than 200."""
    return max(200, -(-int(input_bytes) // target))


def get_session(
    app: str = "logweave",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict | None = None,
    input_bytes: int | None = None,
) -> SparkSession:
    """Build (or reuse) a session with logweave's defaults.

    On a cluster leave ``master`` unset; ``spark-submit`` provides it, and
    pass ``input_bytes`` (size of the log) to size the shuffle partitions.
    """
    if shuffle_partitions is None and input_bytes:
        shuffle_partitions = shuffle_partitions_for(input_bytes)
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Make ``DataFrame.checkpoint()`` usable.

    The cluster names a shared folder in ``spark.checkpoint.dir``; we use it
    as given.  Only a local-mode session without that setting (tests, bench)
    gets a fresh scratch folder of its own.
    """
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if configured:
        sc.setCheckpointDir(configured)
        return configured
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; iterative logweave jobs need a "
            "shared checkpoint folder on a cluster"
        )
    path = tempfile.mkdtemp(prefix="logweave-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    return path


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (survives executor loss), never localCheckpoint."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def kept_table(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a compressed table below the checkpoint folder: a lineage cut for
    large tables of which readers need some columns or rows."""
    path = os.path.join(ensure_checkpoint_dir(df.sparkSession), f"logweave-{name}-{uuid.uuid4().hex}")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# Small lookup tables (day ranks, per-group statistics) up to this many rows
# are fetched and broadcast; larger ones are checkpointed and joined.
SMALL_TABLE_ROWS = 100_000


def small_table(df: DataFrame, cap: int = SMALL_TABLE_ROWS) -> tuple[DataFrame, bool]:
    """``(table, is_small)``: one job fetches at most ``cap + 1`` rows; when
    the table fits, it is rebuilt from those rows (safe to broadcast: its
    size is now known), otherwise it is checkpointed for an ordinary join."""
    rows = df.limit(cap + 1).collect()
    if len(rows) <= cap:
        return df.sparkSession.createDataFrame(rows, df.schema), True
    return cut_lineage(df), False
