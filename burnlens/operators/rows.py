"""Row identity: dense row numbers without a global sort, and a check of keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize

#: Low bits of ``monotonically_increasing_id`` that count inside a partition.
INSIDE = (1 << 33) - 1


class RepeatedKey(ValueError):
    pass


def number_rows(df: DataFrame, name: str = "RowNumber", start: int = 0) -> DataFrame:
    """``df`` with numbers ``start .. start + n - 1``, each once.

    The frame is written with its partition and the row's place there, so the numbers
    don't change when a task runs again; the partitions' sizes (one number for each
    partition) give every partition its offset, which is joined back.  No row is
    sorted or shuffled.
    """
    written = materialize(df.withColumn("_at", F.monotonically_increasing_id()), "rows")
    part = F.shiftright("_at", 33).cast("int")
    sizes = written.groupBy(part.alias("_part")).agg(F.count("*").alias("n")).orderBy("_part").collect()
    offsets, total = [], start
    for r in sizes:
        offsets.append((r["_part"], total))
        total += r["n"]
    known = df.sparkSession.createDataFrame(offsets, "_part int, _offset long")
    out = written.withColumn("_part", part).join(F.broadcast(known), "_part")
    return out.withColumn(name, F.col("_offset") + F.col("_at").bitwiseAND(F.lit(INSIDE))).drop("_part", "_at", "_offset")


def key_report(df: DataFrame, *keys: str) -> DataFrame:
    """``(Rows, Keys, RepeatedKeys, NullKeys)`` of a key, in one aggregate over its counts."""
    null = F.lit(False)
    for k in keys:
        null = null | F.col(k).isNull()
    counts = df.groupBy(*keys).agg(F.count("*").alias("_n"))
    return counts.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("Rows"),
        F.count("*").alias("Keys"),
        F.count_if(F.col("_n") > 1).alias("RepeatedKeys"),
        F.count_if(null).alias("NullKeys"),
    )


def require_unique(df: DataFrame, *keys: str) -> DataFrame:
    """``df``, or an error if a key repeats or is missing."""
    r = key_report(df, *keys).first()
    if r.RepeatedKeys or r.NullKeys:
        raise RepeatedKey(f"({', '.join(keys)}): {r.RepeatedKeys} of {r.Keys} keys repeat, {r.NullKeys} are null")
    return df
