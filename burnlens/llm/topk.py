"""Exact top-k by inner product, term at a time.

Components become integers, ``floor(1024 * x)``.  Queries are handled in blocks
of a bounded number of rows.  A block goes to every task as sparse rows (term ->
queries and weights); each task holds its candidates as postings (term -> rows
and weights) and, one term after the other, scatters the weighted postings into
a dense array of scores per query.  A partition selection keeps each query's
best ``k`` of the task, and these are merged in two levels.  Every block's result
is written before the next block starts.  All sums are exact 64-bit integers.

Defined cases: vectors that are null or hold a null or non-finite component take
no part; a vector's missing trailing components count as 0; an empty vector
scores 0; rows repeated as a whole count once; a row with the query's own
``vec_id`` is no candidate; a null ``vec_id`` takes no part; ties go to the
smaller ``vec_id``; empty tables give no rows.  An id may have several vectors: as a
query it has one ranking over all of them, as a candidate each of their scores (equal
ones once).  Scores that might pass 62 bits stop the job with an error.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from burnlens.llm.common import in_steps, materialize, tidied

K = 10
SCALE = 1024
#: Queries of one block (their sparse rows go to every task) and candidates scored together.
BLOCK_QUERIES, BLOCK_ROWS = 1024, 1024
#: First level of the merge: so many parts a query.
MERGE_PARTS = 32

PARTIAL = "query_id long, vec_id long, score long"
LEAST = np.iinfo(np.int64).min


def integer_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``(vec_id, v array<long>)`` of the vectors that take part."""
    x = F.col(vector_col).cast("array<double>")
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == math.inf))
    huge = F.exists(x, lambda c: F.abs(c) >= F.lit(2.0**62 / SCALE))
    whole = F.transform(x, lambda c: F.floor(c * F.lit(float(SCALE))).cast("long"))
    v = F.when(huge, F.raise_error(F.lit("a vector's components pass 62 bits")).cast("array<bigint>")).otherwise(whole)
    return vectors.where(F.col(id_col).isNotNull() & x.isNotNull() & ~bad).select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v"))


def sparse_rows(rows: list[tuple[int, list[int]]]) -> tuple[np.ndarray, list[tuple[int, np.ndarray, np.ndarray]]]:
    """Query ids, and ``(term, queries, weights)`` for every term with a weight."""
    ids = np.array([i for i, _ in rows], np.int64)
    width = max((len(v) for _, v in rows), default=0)
    dense = np.zeros((len(rows), width), np.int64)
    for k, (_, v) in enumerate(rows):
        dense[k, : len(v)] = v
    terms = []
    for t in range(width):
        if len(q := np.flatnonzero(dense[:, t])):
            terms.append((t, q, dense[q, t]))
    return ids, terms


def postings(column: pa.ListArray) -> list[tuple[np.ndarray, np.ndarray]]:
    """By term: rows with a weight, and the weights."""
    size = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(size)), size)
    term = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
    live = flat != 0
    row, term, flat = row[live], term[live], flat[live]
    order = np.argsort(term, kind="stable")
    bounds = np.searchsorted(term[order], np.arange(int(size.max(initial=0)) + 1))
    return [(row[order[a:b]], flat[order[a:b]]) for a, b in zip(bounds[:-1], bounds[1:])]


def accumulate(n_queries: int, n_rows: int, terms: list[tuple[int, np.ndarray, np.ndarray]], posts: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    scores = np.zeros((n_queries, n_rows), np.int64)
    if sum(float(np.abs(w).max()) * float(np.abs(posts[t][1]).max(initial=0)) for t, _, w in terms if t < len(posts)) >= 2.0**62:
        raise OverflowError("scores pass 62 bits")
    for term, queries, weights in terms:
        if term >= len(posts):
            break
        rows, values = posts[term]
        if len(rows) == n_rows and len(queries) == n_queries:
            scores += weights[:, None] * values
        elif len(rows):
            scores[queries[:, None], rows] += weights[:, None] * values
    return scores


def select(scores: np.ndarray, ids: np.ndarray, own: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(query row, id, score)`` of each row's ``k`` best: higher score, then smaller id."""
    n = scores.shape[1]
    order = np.argsort(ids, kind="stable")
    ids, scores = ids[order], scores[:, order]
    place = np.arange(n - 1, -1, -1)
    live = ids[None, :] != own[:, None]
    if n and np.abs(scores).max(initial=0) < (1 << 62) // max(n, 1):
        key = np.where(live, scores * n + place, LEAST)
        best = np.argpartition(key, n - k, axis=1)[:, n - k :] if n > k else np.broadcast_to(np.arange(n), scores.shape)
    else:
        best = np.array([np.lexsort((ids, -s, ~a))[:k] for s, a in zip(scores, live)], np.int64).reshape(len(scores), -1)
    q = np.repeat(np.arange(len(scores)), best.shape[1])
    best = best.ravel()
    kept = live[q, best]
    q, best = q[kept], best[kept]
    return q, ids[best], scores[q, best]


def block_scores(vectors: DataFrame, block: list[tuple[int, list[int]]], k: int) -> DataFrame:
    own, terms = sparse_rows(block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = (np.zeros(0, np.int64),) * 3
        for whole in batches:
            for at in range(0, whole.num_rows, BLOCK_ROWS):
                batch = whole.slice(at, BLOCK_ROWS)
                ids = batch.column("vec_id").to_numpy()
                column = pa.concat_arrays([batch.column("v")])  # offsets of the slice itself
                new = select(accumulate(len(own), len(ids), terms, postings(column)), ids, own, k)
                q, i, s = (np.concatenate([a, b]) for a, b in zip(held, new))
                order = np.lexsort((i, -s, q))
                q, i, s = q[order], i[order], s[order]
                fresh = np.ones(len(q), bool)
                fresh[1:] = (q[1:] != q[:-1]) | (i[1:] != i[:-1]) | (s[1:] != s[:-1])
                q, i, s = q[fresh], i[fresh], s[fresh]
                first = np.searchsorted(q, q)
                top = np.arange(len(q)) - first < k
                held = (q[top], i[top], s[top])
        q, i, s = held
        yield pa.RecordBatch.from_arrays([pa.array(own[q]), pa.array(i), pa.array(s)], names=["query_id", "vec_id", "score"])

    return vectors.mapInArrow(tidied(run), PARTIAL)


def _best(rows: DataFrame, k: int, *keys: str) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(vectors: DataFrame, is_query: Column, k: int = K, id_col: str = "vec_id", vector_col: str = "embedding", block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """``(query_id, rank, vec_id, score)`` for the rows that ``is_query``, against all rows."""
    clean = materialize(integer_vectors(vectors, id_col, vector_col), "topk-vectors")
    queries = materialize(integer_vectors(vectors.where(is_query), id_col, vector_col).distinct(), "topk-queries")
    blocks = -(-queries.count() // block_queries)
    block_of = F.pmod(F.xxhash64("vec_id"), F.lit(max(blocks, 1)))  # all vectors of one id together

    def found() -> Iterator[DataFrame]:
        for b in range(blocks):
            # About block_queries rows each, whatever the table's size.
            rows = [(r.vec_id, list(r.v)) for r in queries.where(block_of == b).collect()]
            if rows:
                part = block_scores(clean, rows, k).withColumn("part", F.pmod(F.spark_partition_id(), F.lit(MERGE_PARTS)))
                part = _best(part.distinct(), k, "query_id", "part").select("query_id", "vec_id", "score").distinct()
                yield _best(part, k, "query_id").select("query_id", "rank", "vec_id", "score")

    best = in_steps(found(), "topk-found")
    if best is None:
        return clean.select(F.col("vec_id").alias("query_id"), F.lit(0).alias("rank"), "vec_id", F.lit(0).cast("long").alias("score")).where("false")
    return best


def query(vectors: DataFrame) -> DataFrame:
    return top_k(vectors, F.pmod(F.col("vec_id").cast("long"), F.lit(100)) == 0)


SQL = """
WITH v AS (
  SELECT vec_id, e, row_number() OVER () AS n
  FROM (
    SELECT DISTINCT CAST(vec_id AS BIGINT) AS vec_id,
           list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(CAST(x AS DOUBLE)))) = 0
  )
), c AS (
  SELECT vec_id, n, unnest(e) AS w, generate_subscripts(e, 1) AS t FROM v
), s AS (
  SELECT DISTINCT query_id, vec_id, score
  FROM (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(sum(q.w * c.w) AS BIGINT) AS score
    FROM c AS q JOIN c ON c.t = q.t AND c.vec_id <> q.vec_id
    WHERE q.vec_id % 100 = 0
    GROUP BY q.vec_id, q.n, c.vec_id, c.n
  )
), r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""
