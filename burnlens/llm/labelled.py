"""Labelled rows to learn from: an even, bounded sample, and what is held out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from burnlens.llm.common import documents

#: Labelled rows that a classifier is fitted on, at most (about).
SAMPLE_ROWS = 20_000


def held_out(doc_id: Column, divisor: int, remainder: int) -> Column:
    """Whether crc32 of the id as text leaves ``remainder``; a null id isn't held out."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(divisor)) == remainder, F.lit(False))


def sampled_labels(labels: DataFrame, learn: Column, label_col: str, rows: int = SAMPLE_ROWS) -> DataFrame:
    """``(doc_id, label)`` of at most about ``rows`` allowed rows, evenly by hash."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label")).where(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & learn)
    known = known.groupBy("doc_id").agg(F.max("label").alias("label"))
    n = known.count()
    return known if n <= rows else known.where(F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(1_000_000)) < int(1_000_000 * rows / n))


def labelled_texts(docs: DataFrame, sample: DataFrame) -> DataFrame:
    """``(doc_id, text, label)``; the sample is bounded, so it is broadcast."""
    return documents(docs).join(F.broadcast(sample), "doc_id")
