"""Session helpers for tests, the bench and ad-hoc runs.

Library code never builds a session; it reads settings from the session of
the DataFrame it is given.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | None = None, shuffle_partitions: int | None = None,
                  app: str = "applens") -> SparkSession:
    """A local session with AQE on and the web UI off."""
    cores = cores or int(os.environ.get("BENCH_CPUS", "8"))
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's checkpoint folder; create a scratch one only when unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as
    is (its absence is an error). Only a local-mode run without that setting
    gets a fresh folder under /tmp.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/object store): "
                               "checkpoints must survive the loss of an executor")
        configured = tempfile.mkdtemp(prefix="applens-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def fresh_folder(spark: SparkSession, name: str) -> str:
    """The path of a new folder inside the checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def kept_table(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """Write a table as Parquet into the checkpoint folder and read it back: a plain scan that
    survives the loss of executors, with column pruning. ``by`` names a column of few values to partition by."""
    path = fresh_folder(df.sparkSession, name)
    out = df.write.partitionBy(by) if by else df.write
    out.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(df.columns)


ROWS_A_TASK = 50_000


def spread(df: DataFrame, keep_as: str | None = None) -> DataFrame:
    """The same rows over as many partitions as their number asks for.

    A small, well-packed file holds millions of rows in one or two row groups, each read by one task; all row-level
    work, broadcast joins and fits after it would stay in these. Rows are dealt in turn, so copies and NULLs spread too.
    ``keep_as`` writes the dealt rows (see ``kept_table``): filters and their expressions are not moved before the dealing.
    """
    tasks = -(-df.count() // ROWS_A_TASK)
    if tasks <= 1:
        return df
    dealt = df.repartition(tasks)
    return kept_table(dealt, keep_as) if keep_as else dealt
