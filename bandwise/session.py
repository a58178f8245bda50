"""Session helpers: a local session for tests/bench, and lineage cuts."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int | None = None,
                  app: str = "bandwise") -> SparkSession:
    """A local session for tests and the bench (cluster jobs bring their own)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("BANDWISE_DRIVER_MEMORY", "16g"))
    )
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's spark.checkpoint.dir; only an unset local session gets its own."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return conf_dir
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder on this cluster")
    path = tempfile.mkdtemp(prefix="bandwise-ckpt-")
    sc.setCheckpointDir(path)
    return path


def spread(df: DataFrame) -> DataFrame:
    """At least one partition per core for a frame that many passes will read.

    A small table in one file scans as one partition per row group; every
    later pass over it would then run on a single core. Frames that already
    have that many partitions (any large input) are left alone: no shuffle.
    """
    target = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(target) if df.rdd.getNumPartitions() < target else df


#: Rows of a narrow frame that one partition may hold where a loop reads it.
LOOP_ROWS = 1_000_000


def for_loops(df: DataFrame) -> DataFrame:
    """A narrow frame that a loop reads, in as few partitions as keep every core busy (``spread``) and each at about
    LOOP_ROWS rows: a loop pays a task for every partition in every stage, and a scan's partitions follow the
    bytes of all the table's columns, not the rows."""
    have, cores = df.rdd.getNumPartitions(), df.sparkSession.sparkContext.defaultParallelism
    if have <= cores:
        return spread(df)
    wanted = max(cores, -(-df.count() // LOOP_ROWS))
    return df.coalesce(wanted) if wanted < have else df


def cut_lineage(df: DataFrame, spread_out: bool = False) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return (spread(df) if spread_out else df).checkpoint(eager=True)


def stored(df: DataFrame, spread_out: bool = False) -> DataFrame:
    """``df`` written as Parquet beside the checkpoints and read back: survives executor loss like
    a checkpoint, and later passes read only the columns they use."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/stored-{uuid.uuid4().hex}"
    (spread(df) if spread_out else df).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
