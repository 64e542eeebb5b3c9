"""Broadcast only what is proven small, in bytes.

``file_broadcast`` takes the size of a table from its files and runs no job.
``measured_broadcast`` is for derived per-key tables (one row per group), whose
size nothing but the data can tell: the table is written once to the shared
folder, so a lost executor reads it again and nothing stays cached, and its
written size decides. Beyond the bound the plain frame goes into a shuffle
join, whose skewed partitions AQE splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize

# Compressed bytes of a table that every executor may hold.
BROADCAST_BYTES = 16 * 1024 * 1024


def scan_bytes(df: DataFrame, beyond: int | None = BROADCAST_BYTES) -> int:
    """Bytes of the files that a plain scan reads, from the file listing; the count
    stops at the first file that takes it over ``beyond``."""
    spark = df.sparkSession
    conf = spark._jsc.hadoopConfiguration()
    path = spark._jvm.org.apache.hadoop.fs.Path
    total = 0
    for name in df.inputFiles():
        p = path(name)
        total += p.getFileSystem(conf).getFileStatus(p).getLen()
        if beyond is not None and total > beyond:
            break
    return total


def file_broadcast(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """A broadcast hint on a scan (and narrow operations on it) whose files are small."""
    return F.broadcast(df) if scan_bytes(df) <= max_bytes else df


def measured_broadcast(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """The table as written to the shared folder, with a broadcast hint if that is small."""
    return file_broadcast(materialize(df, "stats"), max_bytes)


def with_scalars(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach every column of a 1-row aggregate to each row of ``df``.

    Uses one scalar subquery (a struct of all columns) instead of a cross
    join: the aggregate runs once with partial aggregation and its single
    row is shipped to every task.
    """
    cols = one_row.columns
    packed = one_row.select(F.struct(*cols).alias("_scalar")).scalar()
    out = df.withColumn("_scalar", packed)
    return out.withColumns({c: F.col(f"_scalar.{c}") for c in cols}).drop("_scalar")
