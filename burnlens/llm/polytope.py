"""Near-duplicate vectors by cross-polytope hashing.

1. Equal vectors become one class with its number of rows.
2. A table's hash is ``k`` cross-polytope codes: three rounds of random signs and a
   fast Hadamard transform, then the largest coordinate with its sign (the last code
   only looks at the first ``last`` coordinates).  ``k`` and ``last`` follow the number
   of classes, so that a bucket holds about ``LOAD`` of them at any size.
3. A class lies in its own bucket and probes the ``PROBES`` next likely ones: those
   whose coordinates fall least short of the largest.  How often a pair at exactly the
   threshold meets in one table is measured on ``TRIALS`` drawn pairs (the rotations
   make it independent of the data), and gives the number of tables for ``RECALL``.
4. Rows of a bucket are compared own against own and own against probe, in double
   precision.  A pair that meets several times is counted where it meets first, which
   both its vectors tell from their codes alone; what leaves a bucket is a number of
   links for each class and a spanning forest, never all pairs.  A bucket with more
   rows than ``block_rows`` is cut into blocks whose pairings go to different tasks.

Links below the threshold do not occur; of pairs at the threshold ``RECALL`` are
found, of closer ones more.

Defined cases: one output row per input row; vectors that are null, empty, zero or
hold null or non-finite components have no links and are components of their own;
vectors of different length don't link; repeated rows and equal vectors link with
each other like any others; a null ``vec_id`` links, but is no component's smallest
id unless it has no other (then ``component_id`` is null and ``kept`` false); ties of
coordinates go by position; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import functools
import itertools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from burnlens.llm.common import components, forest, materialize, small_batches, tidied

THRESHOLD = 0.9
RECALL = 0.995
PROBES = 4
#: Coordinates of a code that probes may fall back on.
ALTERNATIVES = 4
#: Classes of one bucket, about.
LOAD = 32
TRIALS = 4000
SEED = 17
#: Rows of one bucket that one task compares; larger buckets are cut into blocks.
BLOCK_ROWS = 4096
#: Rows of one matrix product, and runs that are compared by shifting instead.
TILE, SHORT = 1024, 32
#: Bits of a bucket's number that the codes may take; the rest numbers the table.
CODE_BITS = 55


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Hadamard transform of each row; the width is a power of two."""
    n, width = x.shape
    h = 1
    while h < width:
        y = x.reshape(n, width // (2 * h), 2, h)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], 2).reshape(n, width)
        h *= 2
    return x / math.sqrt(width)


def padded(d: int) -> int:
    return max(2, 1 << (d - 1).bit_length())


@dataclass(frozen=True)
class Scheme:
    """Hash tables for vectors padded to ``width``."""

    width: int
    k: int
    last: int
    tables: int
    probes: int = PROBES

    @functools.cached_property
    def signs(self) -> np.ndarray:
        rng = np.random.default_rng([SEED, self.width])
        return rng.choice(np.array([-1.0, 1.0]), (self.tables, self.k, 3, self.width))

    def codes(self, x: np.ndarray, table: int) -> np.ndarray:
        """``(rows, 1 + probes)`` codes of a table: the own one, then the probes
        (-1 where there are fewer)."""
        if x.shape[1] < self.width:
            x = np.pad(x, ((0, 0), (0, self.width - x.shape[1])))
        choices, short = [], []
        for j in range(self.k):
            y = x
            for signs in self.signs[table, j]:
                y = hadamard(y * signs)
            if j == self.k - 1:
                y = y[:, : self.last]
            size = np.abs(y)
            at = np.argsort(-size, axis=1, kind="stable")[:, :ALTERNATIVES]
            top = np.take_along_axis(size, at, 1)
            choices.append(2 * at + (np.take_along_axis(y, at, 1) < 0))
            short.append((top[:, :1] - top) ** 2)
        picks = list(itertools.product(*(range(s.shape[1]) for s in short)))[1:]
        own = functools.reduce(lambda c, a: c * (2 * self.width) + a[:, 0], choices, np.zeros(len(x), np.int64))
        out = np.full((len(x), 1 + self.probes), -1, np.int64)
        out[:, 0] = own
        # Cheapest first; only picks whose sum of places is small can be among the first few.
        picks = [p for p in picks if math.prod(a + 1 for a in p) <= self.probes + 1]
        if picks:
            cost = np.stack([sum(s[:, a] for s, a in zip(short, p)) for p in picks], 1)
            code = np.stack([functools.reduce(lambda c, ca: c * (2 * self.width) + ca[0][:, ca[1]], zip(choices, p), np.zeros(len(x), np.int64)) for p in picks], 1)
            first = np.argsort(cost, axis=1, kind="stable")[:, : self.probes]
            out[:, 1 : 1 + first.shape[1]] = np.take_along_axis(code, first, 1)
        return out

    def buckets(self, x: np.ndarray, table: int) -> np.ndarray:
        """Codes with the table's number; never equal for two tables."""
        codes = self.codes(x, table)
        return np.where(codes < 0, -1, codes | (table << CODE_BITS))


def meets(own_a: np.ndarray, all_a: np.ndarray, own_b: np.ndarray, all_b: np.ndarray) -> np.ndarray:
    """The bucket in which each pair meets first in this table, or -1: a bucket that is
    one's own and the other's own or probe; of two such, the smaller."""
    none = np.iinfo(np.int64).max
    at_a = np.where((all_b == own_a[:, None]).any(1), own_a, none)
    at_b = np.where((all_a == own_b[:, None]).any(1), own_b, none)
    first = np.minimum(at_a, at_b)
    return np.where(first == none, -1, first)


@functools.lru_cache(maxsize=64)
def scheme(width: int, n: int, threshold: float = THRESHOLD, recall: float = RECALL, load: int = LOAD) -> Scheme:
    """Codes and tables for ``n`` classes of this width."""
    code_bits = (2 * width - 1).bit_length()
    wanted = max(2, -(-n // load))
    k = 1
    while (2 * width) ** k < wanted and (k + 1) * code_bits <= CODE_BITS:
        k += 1
    last = 1
    while (2 * width) ** (k - 1) * 2 * last < wanted and last < width:
        last *= 2
    rng = np.random.default_rng([SEED, width, k, last])
    x = rng.standard_normal((TRIALS, width))
    x /= np.sqrt((x * x).sum(1, keepdims=True))
    z = rng.standard_normal((TRIALS, width))
    z -= (z * x).sum(1, keepdims=True) * x
    z /= np.sqrt((z * z).sum(1, keepdims=True))
    y = threshold * x + math.sqrt(max(0.0, 1 - threshold * threshold)) * z
    one = Scheme(width, k, last, 1)
    a, b = one.codes(x, 0), one.codes(y, 0)
    # A table's chance, less two standard errors.
    p = float((meets(a[:, 0], a, b[:, 0], b) >= 0).mean())
    p = min(max(p - 2 * math.sqrt(p * (1 - p) / TRIALS), 0.01), 1 - 1e-6)
    return Scheme(width, k, last, max(1, math.ceil(math.log(1 - recall) / math.log(1 - p))))


def prepared(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``(vec_id, v)``; ``v`` is null for vectors that link with nothing."""
    element = vectors.schema[vector_col].dataType.elementType if isinstance(vectors.schema[vector_col].dataType, ArrayType) else None
    kind = "float" if isinstance(element, FloatType) else "double"
    x = F.col(vector_col).cast(f"array<{kind}>")
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == math.inf))
    live = F.exists(x, lambda c: c != 0)
    zero = F.lit(0).cast(kind)  # turns -0.0 into 0.0
    v = F.when(x.isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.coalesce(live, F.lit(False)), F.transform(x, lambda c: c + zero))
    return vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v"))


def matrices(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows and their vectors, by length, each scaled by its largest component."""
    column = pa.concat_arrays([column])
    offsets = column.offsets.to_numpy()
    size = np.diff(offsets)
    flat = column.values.to_numpy(zero_copy_only=False).astype(np.float64)
    for d in np.unique(size):
        rows = np.flatnonzero(size == d)
        x = flat[offsets[rows][:, None] + np.arange(d)]
        yield rows, x / np.abs(x).max(1, keepdims=True)


def bucket_rows(classes: DataFrame, schemes: dict[int, Scheme], kind: str) -> DataFrame:
    """``(bucket, dim, own, node, n, v)``: every class in its own and its probed buckets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, x in matrices(batch.column("v")) if batch.num_rows else ():
                plan = schemes[padded(x.shape[1])]
                for table in range(plan.tables):
                    buckets = plan.buckets(x, table)
                    at, place = np.nonzero(buckets >= 0)
                    pick = pa.array(rows[at])
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(buckets[at, place]),
                            pa.array(np.full(len(at), x.shape[1], np.int32)),
                            pa.array(place == 0),
                            batch.column("node").take(pick),
                            batch.column("n").take(pick),
                            batch.column("v").take(pick),
                        ],
                        names=["bucket", "dim", "own", "node", "n", "v"],
                    )

    return classes.mapInArrow(tidied(run), f"bucket long, dim int, own boolean, node long, n long, v array<{kind}>")


def close_pairs(run: np.ndarray, unit: np.ndarray, least: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of equal ``run`` (sorted) whose unit vectors' product is at least ``least``."""
    starts = np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1]]))
    sizes = np.diff(np.append(starts, len(run)))
    live = np.flatnonzero(np.repeat(sizes <= SHORT, sizes))
    gap = 1
    while True:
        live = live[live + gap < len(run)]
        live = live[run[live] == run[live + gap]]
        if not len(live):
            break
        for k in range(0, len(live), 1 << 16):
            i = live[k : k + (1 << 16)]
            near = np.einsum("ij,ij->i", unit[i], unit[i + gap]) >= least
            yield i[near], i[near] + gap
        gap += 1
    for start, size in zip(starts[sizes > SHORT], sizes[sizes > SHORT]):
        for a in range(start, start + size, TILE):
            left = unit[a : min(a + TILE, start + size)]
            for b in range(a, start + size, TILE):
                i, j = np.nonzero(left @ unit[b : min(b + TILE, start + size)].T >= least)
                i, j = i + a, j + b
                yield i[i < j], j[i < j]


def first_meeting(plan: Scheme, x: np.ndarray, i: np.ndarray, j: np.ndarray, bucket: np.ndarray) -> np.ndarray:
    """Whether the pairs ``(i, j)`` of rows of ``x`` meet in their ``bucket`` for the first time."""
    used, back = np.unique(np.concatenate([i, j]), return_inverse=True)
    a, b, x = back[: len(i)], back[len(i) :], x[used]
    out = np.zeros(len(i), bool)
    left = np.arange(len(i))
    for table in range(plan.tables):
        buckets = plan.buckets(x, table)
        there = meets(buckets[a[left], 0], buckets[a[left]], buckets[b[left], 0], buckets[b[left]])
        met = there >= 0
        out[left[met]] = there[met] == bucket[left[met]]
        left = left[~met]
        if not len(left):
            break
    return out


def run_links(run: np.ndarray, cols: dict[str, np.ndarray], x: np.ndarray, plan: Scheme, threshold: float) -> tuple[np.ndarray, ...]:
    """Links first met in these runs: classes with their numbers of linked rows, and a spanning forest."""
    norm = np.sqrt((x * x).sum(1))
    unit = x / norm[:, None]
    nodes, at = np.unique(cols["node"], return_inverse=True)
    links = np.zeros(len(nodes), np.int64)
    root = np.arange(len(nodes))
    for i, j in close_pairs(run, unit, threshold - 1e-9):
        apart = cols["block"][i] != cols["block"][j]
        keep = (cols["own"][i] | cols["own"][j]) & (apart | (cols["lo"][i] == cols["hi"][i])) & (at[i] != at[j])
        i, j = i[keep], j[keep]
        near = np.einsum("ij,ij->i", x[i], x[j]) / (norm[i] * norm[j]) >= threshold
        i, j = i[near], j[near]
        if not len(i):
            continue
        new = first_meeting(plan, x, i, j, cols["bucket"][i])
        i, j = i[new], j[new]
        np.add.at(links, at[i], cols["n"][j])
        np.add.at(links, at[j], cols["n"][i])
        root = forest(len(nodes), np.concatenate([at[i], np.arange(len(nodes))]), np.concatenate([at[j], root]))
    linked = links > 0
    child = root != np.arange(len(nodes))
    return nodes[linked], links[linked], nodes[child], nodes[root[child]]


def link_rows(rows: DataFrame, schemes: dict[int, Scheme], threshold: float, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``(a, b, links)``: links of ``a`` first met in a run (``b`` null), and forest links ``a-b``."""
    sizes = rows.groupBy("bucket", "dim").agg(F.count("*").alias("rows"))
    large = sizes.where(F.col("rows") > block_rows).select("bucket", "dim", F.ceil(F.col("rows") / (block_rows // 2)).cast("int").alias("blocks"))
    rows = rows.join(large, ["bucket", "dim"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    order = ["bucket", "dim", "lo", "hi"]
    rows = rows.select("bucket", "dim", F.least("block", "with").alias("lo"), F.greatest("block", "with").alias("hi"), "block", "own", "node", "n", "v")
    names = ["bucket", "lo", "hi", "block", "own", "node", "n"]

    def emit(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        numbers = [batch.column(c).to_numpy(zero_copy_only=False) for c in order]
        new = np.zeros(batch.num_rows, bool)
        for c in numbers:
            new[1:] |= c[1:] != c[:-1]
        run = np.cumsum(new)
        cols = dict(zip(names, (batch.column(c).to_numpy(zero_copy_only=False) for c in names)))
        for at, x in matrices(batch.column("v")):
            node, links, a, b = run_links(run[at], {c: v[at] for c, v in cols.items()}, x, schemes[padded(x.shape[1])], threshold)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([node, a])),
                    pa.concat_arrays([pa.nulls(len(node), pa.int64()), pa.array(b)]),
                    pa.concat_arrays([pa.array(links), pa.nulls(len(a), pa.int64())]),
                ],
                names=["a", "b", "links"],
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            whole = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            tail = [whole.column(c)[-1].as_py() for c in order]
            same = np.ones(whole.num_rows, bool)
            for c, v in zip(order, tail):
                same &= whole.column(c).to_numpy() == v
            done = int(np.argmax(same))
            if done:
                yield from emit(whole.slice(0, done).combine_chunks().to_batches()[0])
            held = whole.slice(done)
        if held is not None:
            yield from emit(held.combine_chunks().to_batches()[0])

    return rows.repartition(*order).sortWithinPartitions(*order).mapInArrow(tidied(run), "a long, b long, links long")


def near_duplicates(
    vectors: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, id_col: str = "vec_id", vector_col: str = "embedding", block_rows: int = BLOCK_ROWS, load: int = LOAD
) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)``, one row per input row."""
    small_batches(vectors.sparkSession)
    rows = materialize(prepared(vectors, id_col, vector_col), "polytope-vectors")
    kind = rows.schema["v"].dataType.elementType.simpleString()
    classes = rows.where("v IS NOT NULL").groupBy("v").agg(F.count("*").alias("n"), F.min("vec_id").alias("low"))
    classes = materialize(classes.withColumn("node", F.monotonically_increasing_id()), "polytope-classes")
    # Powers of two: a few numbers whatever the lengths.
    width = F.greatest(F.lit(2), F.pow(F.lit(2.0), F.ceil(F.log2(F.size("v")))).cast("int"))
    widths = {r.width: r.classes for r in classes.groupBy(width.alias("width")).agg(F.count("*").alias("classes")).collect()}
    schemes = {w: scheme(w, n, threshold, recall, load) for w, n in widths.items()}
    met = materialize(link_rows(materialize(bucket_rows(classes, schemes, kind), "polytope-buckets"), schemes, threshold, block_rows), "polytope-links")
    numbers = met.where("b IS NULL").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    roots = components(met.where("b IS NOT NULL").select("a", "b"), "polytope")
    rooted = classes.join(numbers, "node", "left").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    rooted = materialize(rooted.select("v", "n", "low", "links", "root"), "polytope-roots")
    lowest = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    found = rooted.join(lowest, "root").select("v", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id")
    alone = rows.where("v IS NULL").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    out = rows.where("v IS NOT NULL").join(found, "v").select("vec_id", "n_links", "component_id").union(alone)
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def query(vectors: DataFrame) -> DataFrame:
    return near_duplicates(vectors)


#: Every pair by its cosine; equal to the query where no pair is lost (see the tests' recall).
SQL = """
WITH RECURSIVE r AS (
  SELECT CAST(vec_id AS BIGINT) AS vec_id, CAST(embedding AS DOUBLE[]) AS v, row_number() OVER () AS n FROM embeddings
), u AS (
  SELECT n, vec_id, v, sqrt(list_inner_product(v, v)) AS norm FROM r
  WHERE v IS NOT NULL AND len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(v, lambda x: x <> 0)) > 0
), l AS (
  SELECT a.n AS a, b.n AS b FROM u AS a JOIN u AS b ON a.n <> b.n AND len(a.v) = len(b.v)
  WHERE list_inner_product(a.v, b.v) / (a.norm * b.norm) >= 0.9
), c AS (
  SELECT n AS a, n AS b FROM r
  UNION
  SELECT c.a, l.b FROM c JOIN l ON c.b = l.a
), s AS (
  SELECT c.a AS n, min(r.vec_id) AS component_id FROM c JOIN r ON c.b = r.n GROUP BY c.a
), k AS (
  SELECT a AS n, count(*) AS n_links FROM l GROUP BY a
)
SELECT r.vec_id, coalesce(k.n_links, 0) AS n_links, s.component_id, coalesce(r.vec_id = s.component_id, false) AS kept
FROM r JOIN s USING (n) LEFT JOIN k USING (n)
"""
