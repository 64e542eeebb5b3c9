"""Near-duplicate groups by SimHash with a generalised pigeonhole join.

Fingerprint: words of the A-Z lower-cased text, every 4-word shingle (repeats
included), XXH64 with seed 42, majority of each bit.  Two fingerprints link at
``max_bits`` or fewer differing bits.

The join works on distinct fingerprints:

1. Pairwise bit counts over all fingerprints give the correlation of the 64
   bits; correlated bits are put into the same partition, so the other
   partitions stay selective.
2. For every number of partitions, dynamic programming gives each partition its
   own threshold ``t_i`` (-1: not probed) with ``sum(t_i + 1) = max_bits + 1``,
   which by the pigeonhole principle loses no pair.  It minimises estimated cost:
   probes emitted plus candidates compared, the latter from each bit's measured
   frequency.
3. Each fingerprint is indexed by its exact partition values and probes the
   values within ``t_i`` bits.  A pair one bit apart in a partition is probed from
   the side that holds 0 there; wider radii are probed from both sides.
4. Rows are shuffled by (partition, value) and sorted; runs of equal keys are
   compared with popcount(xor) in numpy.  What leaves a run is a spanning forest
   of its links, never all pairs.  A run with more rows than ``block_rows` is cut
   into blocks whose pairings go to different tasks.

Defined cases: null or empty text -> fingerprint 0, linked like any other; fewer
than four words -> the whole sequence is the one shingle; repeated rows and
equal texts share a fingerprint; a null ``doc_id`` takes its group's smallest id
(null if the group has none); an empty table gives no rows.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from burnlens.llm.common import components, documents, forest, map_arrow, materialize, small_batches, texts, tidied

SHINGLE = 4
MAX_BITS = 4
SEED = 42
BITS = 64
#: Rows of one (partition, value) run that one task compares; larger runs are cut into blocks.
BLOCK_ROWS = 4096
#: Relative cost of emitting a probe row and of comparing a candidate.
PROBE_COST, CANDIDATE_COST = 1.0, 0.003


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    words = text.lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    joined = b" ".join(words)
    ends = list(itertools.accumulate(len(w) + 1 for w in words))
    starts = [0, *ends]
    tails = ends[min(shingle, len(words)) - 1 :]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[s : e - 1], SEED) for s, e in zip(starts, tails)), np.uint64, n)
    ones = np.zeros(BITS, np.int64)
    for k in range(0, n, 1 << 15):
        ones += np.unpackbits(hashes[k : k + (1 << 15)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, *keep: str) -> DataFrame:
    """``(doc_id, fp long)``: the 64 bits as a signed long."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        fps = np.array([fingerprint(t, shingle) for t in texts(batch.column("text"))], np.uint64).view(np.int64)
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fps)], names=["doc_id", "fp"])

    return map_arrow(documents(docs), run, "doc_id long, fp long")


def bit_counts(fps: DataFrame) -> np.ndarray:
    """64 x 64 counts of bits set together, over all fingerprints."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((BITS, BITS), np.float64)
        for batch in batches:
            x = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint8).reshape(-1, 8)
            for k in range(0, len(x), 1 << 14):
                bits = np.unpackbits(x[k : k + (1 << 14)], axis=1, bitorder="little").astype(np.float32)
                total += bits.T @ bits
        yield pa.RecordBatch.from_arrays([pa.array(range(BITS), pa.int32()), pa.array(total.astype(np.int64).tolist(), pa.list_(pa.int64()))], names=["i", "c"])

    rows = fps.mapInArrow(tidied(run), "i int, c array<long>").select("i", F.posexplode("c").alias("j", "n")).groupBy("i", "j").agg(F.sum("n").alias("n")).collect()
    out = np.zeros((BITS, BITS))
    for r in rows:  # 4,096 at most
        out[r.i, r.j] = r.n
    return out


def partition_bits(together: np.ndarray, n: int, parts: int) -> list[list[int]]:
    """``parts`` groups of nearly equal width; each starts at the free bit with
    the strongest correlations left and takes the bits that follow it most."""
    p = np.diag(together) / max(n, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    corr = np.abs(together / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread)
    np.fill_diagonal(corr, 0)
    free, out = set(range(BITS)), []
    for k in range(parts):
        width = (BITS - k + parts - 1) // parts
        order = sorted(free)
        group = [max(order, key=lambda b: (corr[b, order].sum(), -b))]
        while len(group) < width:
            group.append(max((b for b in order if b not in group), key=lambda b: (corr[b, group].sum(), -b)))
        free -= set(group)
        out.append(sorted(group))
    return out


def within(p: np.ndarray, group: list[int], most: int) -> list[float]:
    """Probability that two fingerprints differ in 0, up to 1, ... up to ``most`` bits of ``group``."""
    law = [1.0] + [0.0] * most
    for b in group:
        d = 2 * p[b] * (1 - p[b])
        law = [law[k] * (1 - d) + (law[k - 1] * d if k else 0) for k in range(most + 1)]
    return list(itertools.accumulate(law))


def allocate(p: np.ndarray, n: int, groups: list[list[int]], max_bits: int) -> tuple[float, list[int]]:
    """Cheapest thresholds with ``sum(t + 1) = max_bits + 1``, by dynamic programming over the partitions."""
    need = max_bits + 1
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for group in groups:
        near, step = within(p, group, max_bits), {}
        for used, (cost, chosen) in best.items():
            for t in range(-1, need - used):
                probes = sum(float(np.prod([(len(group) - k) / (k + 1) for k in range(d)])) * (0.5 if d == 1 else 1) for d in range(t + 1))
                more = 0.0 if t < 0 else PROBE_COST * probes + CANDIDATE_COST * n * near[t]
                if used + t + 1 not in step or cost + more < step[used + t + 1][0]:
                    step[used + t + 1] = (cost + more, [*chosen, t])
        best = step
    return best[need]


def plan(together: np.ndarray, n: int, max_bits: int = MAX_BITS) -> tuple[list[list[int]], list[int]]:
    """Bit partitions and their thresholds, the cheapest over 1 to max_bits + 2 partitions."""
    p = np.diag(together) / max(n, 1)
    options = []
    for parts in range(2, max_bits + 3):
        groups = partition_bits(together, n, parts)
        cost, thresholds = allocate(p, n, groups, max_bits)
        options.append((cost, parts, groups, thresholds))
    _, _, groups, thresholds = min(options, key=lambda o: o[:2])
    kept = [(g, t) for g, t in zip(groups, thresholds) if t >= 0]
    return [g for g, _ in kept], [t for _, t in kept]


def probes(fps: DataFrame, groups: list[list[int]], thresholds: list[int]) -> DataFrame:
    """``(part, value, probe, fp)``: each fingerprint's own partition values and the values it probes."""
    masks = [np.uint64(sum(1 << b for b in g)) for g in groups]
    singles = [np.array([1 << b for b in g], np.uint64) for g in groups]
    wider = [
        np.array([sum(1 << b for b in c) for d in range(2, t + 1) for c in itertools.combinations(g, d)], np.uint64)
        for g, t in zip(groups, thresholds)
    ]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
        part, value, probe, fp = [], [], [], []

        def add(k: int, v: np.ndarray, f: np.ndarray, is_probe: bool) -> None:
            part.append(np.full(len(v), k, np.int32))
            value.append(v)
            fp.append(f)
            probe.append(np.full(len(v), is_probe))

        for k, t in enumerate(thresholds):
            own = x & masks[k]
            add(k, own, x, False)
            if t >= 1:
                for bit in singles[k]:
                    zero = (own & bit) == 0
                    add(k, own[zero] | bit, x[zero], True)
            for flip in wider[k]:
                add(k, own ^ flip, x, True)
        columns = [pa.array(np.concatenate(part)), pa.array(np.concatenate(value).view(np.int64)), pa.array(np.concatenate(probe)), pa.array(np.concatenate(fp).view(np.int64))]
        return pa.RecordBatch.from_arrays(columns, names=["part", "value", "probe", "fp"])

    return map_arrow(fps, run, "part int, value long, probe boolean, fp long")


def run_links(key: np.ndarray, fp: np.ndarray, probe: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links of rows with equal ``key`` (sorted): own values against own
    values and probes, within ``max_bits``.

    Rows at distance 1, 2, ... in the sorted order are compared at once, so many
    short runs cost as little as one long run.
    """
    nodes, at = np.unique(fp, return_inverse=True)
    root = np.arange(len(nodes))
    a, b, held = [], [], 0
    live = np.arange(len(key))
    gap = 1
    while True:
        live = live[live + gap < len(key)]
        live = live[key[live] == key[live + gap]]
        if not len(live):
            break
        other = live + gap
        near = (np.bitwise_count(fp[live] ^ fp[other]) <= max_bits) & ~(probe[live] & probe[other])
        if near.any():
            a.append(root[at[live[near]]])
            b.append(root[at[other[near]]])
            held += len(a[-1])
            if held > 1 << 18:
                root = forest(len(nodes), np.concatenate([*a, np.arange(len(nodes))]), np.concatenate([*b, root]))
                a, b, held = [], [], 0
        gap += 1
    if a:
        root = forest(len(nodes), np.concatenate([*a, np.arange(len(nodes))]), np.concatenate([*b, root]))
    linked = root != np.arange(len(nodes))
    return nodes[linked], nodes[root[linked]]


def links(fps: DataFrame, groups: list[list[int]], thresholds: list[int], max_bits: int = MAX_BITS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``(a, b)``: links between distinct fingerprints that span every group of
    fingerprints within ``max_bits`` of each other."""
    rows = materialize(probes(fps, groups, thresholds), "simhash-probes")
    sizes = rows.groupBy("part", "value").agg(F.count("*").alias("n"))
    large = sizes.where(F.col("n") > block_rows).select("part", "value", F.ceil(F.col("n") / (block_rows // 2)).cast("int").alias("blocks"))
    rows = rows.join(large, ["part", "value"], "left").select(
        "part", "value", "probe", "fp", F.coalesce("blocks", F.lit(1)).alias("blocks"), F.pmod(F.xxhash64("fp"), F.coalesce("blocks", F.lit(1))).cast("int").alias("block")
    )
    # A row of block i meets every block: pairing (min, max) of the two numbers.
    rows = rows.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        F.xxhash64("part", "value", F.least("block", "with"), F.greatest("block", "with")).alias("bucket"),
        "part",
        "value",
        F.least("block", "with").alias("lo"),
        F.greatest("block", "with").alias("hi"),
        "probe",
        "fp",
    )
    order = ["part", "value", "lo", "hi"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def close(x: list[np.ndarray]) -> pa.RecordBatch:
            a, b = run_links(x[0], x[2].view(np.uint64), x[1], max_bits)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("bucket", "probe", "fp")]
            held = [np.concatenate([h, c]) for h, c in zip(held, cols)] if held else cols
            key = held[0]
            last = len(key) - int(np.argmax(key[::-1] != key[-1])) if (key != key[-1]).any() else 0
            if last:
                yield close([h[:last] for h in held])
                held = [h[last:] for h in held]
        if held:
            yield close(held)

    dealt = rows.repartition("bucket").sortWithinPartitions("bucket", *order).select("bucket", "probe", "fp")
    return dealt.mapInArrow(tidied(run), "a long, b long").distinct()


def classes(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame | None:
    """``(fp, low, root)`` of the distinct fingerprints of ``prints(doc_id, fp)``:
    smallest id and the group's smallest fingerprint; None without rows."""
    distinct = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("low")), "simhash-distinct")
    n = distinct.count()
    if not n:
        return None
    groups, thresholds = plan(bit_counts(distinct), n, max_bits)
    roots = materialize(components(links(distinct.select("fp"), groups, thresholds, max_bits), "simhash"), "simhash-roots")
    return distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))


def simhash_groups(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """``(doc_id, fp, component_id)``, one row per input row."""
    prints = materialize(fingerprints(docs, shingle), "simhash-prints")
    rooted = classes(prints, max_bits)
    if rooted is None:
        return prints.withColumn("component_id", F.lit(None).cast("long"))
    lowest = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    return prints.join(rooted.join(lowest, "root").select("fp", "component_id"), "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group, with all columns of ``docs``: that of the smallest id (a row
    without an id only if the whole group has none; one of repeated rows)."""
    small_batches(docs.sparkSession)
    fp, row = "__simhash_fp", "__simhash_row"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(t, shingle) for t in texts(batch.column(batch.schema.get_field_index(text_col)))]
            yield batch.append_column(fp, pa.array(np.array(prints, np.uint64).view(np.int64)))

    whole = docs.mapInArrow(tidied(run), StructType([*docs.schema.fields, StructField(fp, LongType())]))
    whole = materialize(whole.withColumn(row, F.monotonically_increasing_id()), "simhash-documents")
    slim = whole.select(F.col(id_col).cast("long").alias("doc_id"), F.col(fp).alias("fp"), F.col(row).alias("row"))
    rooted = classes(slim.select("doc_id", "fp"), max_bits)
    if rooted is None:
        return docs
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row"))
    lowest = slim.groupBy("fp").agg(first.alias("first")).join(rooted.select("fp", "root"), "fp").groupBy("root").agg(F.min("first").alias("first"))
    return whole.join(lowest.select(F.col("first.row").alias(row)), row, "left_semi").drop(fp, row)


def query(docs: DataFrame) -> DataFrame:
    return simhash_groups(docs).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
