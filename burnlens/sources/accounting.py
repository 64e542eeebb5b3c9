"""Row accounting of text sources: what was read, what was refused and why, in one pass."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as C
from ..session import CODEC, checkpoint_dir, remove_at_exit
from .io import RAW_SCHEMA

#: Reasons in the order in which they are looked for; a row has the first that holds.
MALFORMED, BAD_TIME, BAD_TARGET = "malformed row", "unparsed time", "target not positive"
TIMES = ["DepartureScheduled", "ArrivalScheduled"]
#: Rows of a text file at most: a compressed file is read by one task.
TEXT_FILE_ROWS = 1_000_000


def write_text(rows: DataFrame, path: str) -> None:
    """A header CSV, compressed: as plain text the fact takes three times as much of the disk."""
    rows.write.option("header", True).option("compression", "gzip").option("maxRecordsPerFile", TEXT_FILE_ROWS).csv(path)


def read_counted(spark: SparkSession, path: str, target: str | None = C.TARGET, schema: T.StructType = RAW_SCHEMA, timestamp_format: str | None = None) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """``(accepted, rejected, counts)`` of a header CSV.

    Every row is written once, with the reason why it is refused (null: none), and
    counted while it is written; ``accepted`` has the schema's columns, ``rejected`` the
    reason and the row's raw text too.  Without a target (the scoring variant) rows are
    not refused for it.
    """
    raw, why = "_raw", "Reason"
    fields = [T.StructField(f.name, T.StringType()) if f.name in TIMES else f for f in schema.fields]
    rows = (
        spark.read.schema(T.StructType([*fields, T.StructField(raw, T.StringType())]))
        .option("header", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", raw).csv(path)
    )
    parsed, unparsed = {}, F.lit(False)
    for c in TIMES:
        if c in rows.columns:
            text = F.trim(F.col(c))
            parsed[c] = F.try_to_timestamp(text, F.lit(timestamp_format)) if timestamp_format else F.try_to_timestamp(text)
            unparsed = unparsed | ((F.length(text) > 0) & parsed[c].isNull())
    unparsed = F.coalesce(unparsed, F.lit(False))
    reason = F.when(F.col(raw).isNotNull(), MALFORMED).when(unparsed, BAD_TIME)
    if target:
        reason = reason.when(~F.coalesce(F.col(target) > 0, F.lit(False)), BAD_TARGET)
    rows = rows.withColumn(why, reason).withColumns({c: v.cast("timestamp_ntz") for c, v in parsed.items()})
    seen = Observation()
    rows = rows.observe(
        seen,
        F.count("*").alias("read"),
        F.count_if(F.col(why).isNull()).alias("accepted"),
        *[F.count_if(F.col(why) == r).alias(r) for r in (MALFORMED, BAD_TIME, BAD_TARGET)],
    )
    written = f"{checkpoint_dir(spark)}/burnlens/accounted-{uuid.uuid4().hex}"
    remove_at_exit(spark, written)
    rows.write.option("compression", CODEC).parquet(written)
    back = spark.read.parquet(written)
    return back.where(F.col(why).isNull()).drop(why, raw), back.where(F.col(why).isNotNull()), dict(seen.get)
