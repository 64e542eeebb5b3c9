"""Session helpers: building a local session for tests/bench, finding the shared
checkpoint folder, and materialising an intermediate table there.

On a cluster the session is built by the platform; the library only *reads*
``spark.checkpoint.dir`` from it and falls back to a private folder when the
setting is absent (tests, laptops).
"""

from __future__ import annotations

import atexit
import contextlib
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


#: Parquet codec of written tables: a fact of doubles is smaller than with the default.
CODEC = "zstd"


def build_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "burnlens") -> SparkSession:
    """Local session with the settings the library assumes (UTC, AQE, no UI)."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", os.environ.get("BURNLENS_DRIVER_MEMORY", "6g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> None:
    """Session settings the operators rely on; safe to call on any session."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    # No broadcast from planner estimates: after column pruning and
    # generators they can be off by orders of magnitude (a 6.6M-row frame
    # was estimated under 10 MB). Broadcasts come from explicit, size-checked
    # hints or from AQE on measured shuffle sizes.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", str(32 * 1024 * 1024))
    checkpoint_dir(spark)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only when a local session does not name one (tests, laptops) do we set a
    private folder of our own; on a cluster it would be a different disk on
    every machine, so there a missing setting is an error.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None
    )
    if conf_dir:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(conf_dir)
        return conf_dir.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="burnlens-ckpt-")
    spark.conf.set("spark.checkpoint.dir", local)
    spark.sparkContext.setCheckpointDir(local)
    return local


def remove_at_exit(spark: SparkSession, path: str) -> None:
    """Delete a written folder when the driver's Python ends (best effort: the
    session may be gone by then, and then the folder's owner cleans up)."""

    def remove() -> None:
        if spark._jsc.sc().isStopped():
            return
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)

    def quietly() -> None:
        with contextlib.suppress(Exception):
            remove()

    atexit.register(quietly)


def materialize(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` as Parquet under the checkpoint folder and read it back.

    This cuts lineage (a lost executor re-reads the files instead of
    recomputing the joins) and gives later stages column pruning and
    predicate pushdown on a columnar copy.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/burnlens/{name}-{uuid.uuid4().hex}"
    remove_at_exit(spark, path)
    writer = df.write.mode("overwrite").option("compression", CODEC)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.parquet(path)


def ensure_parallelism(df: DataFrame, *keys: str) -> DataFrame:
    """Spread an under-split input over the cluster.

    A fact stored as one large file with a single row group is read by one
    task, and broadcast joins keep it there. When the scan has fewer splits
    than the session's default parallelism, hash-partition it (by ``keys``
    when given) to twice that; a large input (thousands of splits) is
    returned untouched, so no shuffle is added at scale.
    """
    target = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= target:
        return df
    n = 2 * target
    return df.repartition(n, *keys) if keys else df.repartition(n)
