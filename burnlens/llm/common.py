"""Helpers shared by the corpus operators: input shape, Arrow batch mapping,
stage tables and connected components."""

from __future__ import annotations

import ctypes
import functools
import itertools
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from burnlens.session import checkpoint_dir, materialize, remove_at_exit

BATCH_ROWS = 1024

__all__ = ["checkpoint_dir", "components", "documents", "forest", "in_steps", "map_arrow", "materialize", "small_batches", "table", "texts", "tidied"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of at most ``BATCH_ROWS`` rows from here on: the default of 10,000
    whole documents takes several copies of tens of MB in every task."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def documents(docs: DataFrame, *more: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id long, text string)`` plus ``more``; a null text counts as empty.

    Only these columns are read, so extra columns of the input, whatever they
    are called, can't clash with what an operator adds.
    """
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
        *more,
    )


def texts(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """UTF-8 bytes of a string column; nulls become empty."""
    return [b or b"" for b in column.cast(pa.binary()).to_pylist()]


def _give_back() -> None:
    """Return freed memory to the system: a worker process lives on between tasks, and
    the allocators' unused pages of two workers are a third of a small executor."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def tidied(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A task function that gives its memory back when it ends."""

    @functools.wraps(run)
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            _give_back()

    return task


def map_arrow(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """``mapInArrow`` for functions that keep no state between batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows and (out := fn(batch)) is not None:
                yield out

    return df.mapInArrow(tidied(run), schema)


def in_steps(steps: Iterable[DataFrame], name: str) -> DataFrame | None:
    """The union of many frames, each written before the next one starts, so
    neither the plan nor what a lost executor must repeat grows with their number.
    A single frame stays as it is."""
    steps = iter(steps)
    first, second = next(steps, None), next(steps, None)
    if second is None:
        return first
    spark = first.sparkSession
    path = f"{checkpoint_dir(spark)}/burnlens/{name}-{uuid.uuid4().hex}"
    remove_at_exit(spark, path)
    for step in itertools.chain([first, second], steps):
        step.write.mode("append").parquet(path)
    return spark.read.parquet(path)


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest node number of each node's component, for nodes ``0..n-1`` and
    undirected links ``a-b`` (hooking with pointer jumping)."""
    root = np.arange(n)
    while len(a):
        ra, rb = root[a], root[b]
        live = ra != rb
        if not live.any():
            break
        a, b, ra, rb = a[live], b[live], ra[live], rb[live]
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while not np.array_equal(root, hop := root[root]):
            root = hop
    return root


def components(links: DataFrame, name: str) -> DataFrame:
    """Connected components of ``links(a long, b long)``: ``(node, root)`` with
    the smallest node of each component as its root, for nodes with a link.

    Alternating large-star and small-star rounds.  Each round is a map-side
    combined ``min`` per node and a join that AQE may split, so a node with very
    many neighbours is no single task; rounds are written to the shared folder,
    so lineage stays short.  The number of rounds is logarithmic in practice.
    """
    def lowest(pairs: DataFrame) -> DataFrame:
        return pairs.groupBy("a").agg(F.min("b").alias("m"))

    edges = materialize(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), f"{name}-links"
    )
    before = None
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = lowest(both).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        low = lowest(large)
        small = (
            large.join(low, "a")
            .select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct(F.col("a").alias("a"), F.col("m").alias("b")))).alias("e"))
            .select("e.a", "e.b")
            .where("a <> b")
            .distinct()
        )
        edges = materialize(small, f"{name}-links")
        now = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if before is not None and tuple(now) == before:
            break
        before = tuple(now)
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(roots.select(F.col("root").alias("node"), "root").distinct())
