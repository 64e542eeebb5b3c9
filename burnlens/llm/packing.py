"""Shortest-pack-first packing over the length histogram.

1. Each document is tokenized once and closed with the end id.  Whole chunks of
   ``limit`` ids are full sequences; the rest is one piece.  Each task numbers
   its pieces of equal length as it writes them, so no window ever holds all
   pieces of one length.
2. The histogram of piece lengths (``limit`` bins at most) is packed on the
   driver, longest length first: each piece goes to the pack with the fewest
   tokens if it fits there, else it opens a new pack.  Packs with the same
   content are one pattern with a count, so the work depends on the number of
   lengths, not of documents.
3. A pattern's slot of length L takes a range of the ranks of length L.  A
   piece's rank is its number in its task plus the counts of earlier tasks; a
   binary search over the slot ranges (bounded by lengths and limit, not by
   rows) gives its sequence and offset.

Defined cases: a null or empty text is the end id alone; repeated rows are
packed once each; a null ``doc_id`` is kept; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from burnlens.llm.common import documents, materialize, tidied
from burnlens.llm.wordbpe import WordBpe

LIMIT = 4096
END_ID = 2
VOCABULARY = "word_bpe_49k.json"
#: Documents whose ids a task holds at a time.
CHUNK_ROWS = 1024

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, task int, nth long"


def pieces(docs: DataFrame, vocabulary: str, end_id: int = END_ID, limit: int = LIMIT) -> DataFrame:
    """Pieces of every document; ``nth`` counts the task's pieces of that length."""
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, seen = WordBpe.of(vocabulary), Counter()
        task = TaskContext.get().partitionId()
        for whole in batches:
            for at in range(0, whole.num_rows, CHUNK_ROWS):
                batch = whole.slice(at, CHUNK_ROWS)
                rows: list[tuple] = []
                for doc_id, ids in zip(batch.column("doc_id").to_pylist(), bpe.ids(batch.column("text").to_pylist())):
                    ids += end
                    n = len(ids) // 4
                    for start in range(0, n, limit):
                        length = min(limit, n - start)
                        rows.append((doc_id, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)]), n, task, seen[length]))
                        seen[length] += 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), [pa.int64()] * 5 + [pa.int32(), pa.int64()])],
                    names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "task", "nth"],
                )

    return documents(docs).mapInArrow(tidied(run), PIECES)


def pack_lengths(histogram: dict[int, int], limit: int = LIMIT) -> list[tuple[int, list[int]]]:
    """``(count, lengths)`` of each pattern, shortest pack first."""
    # A pattern is a chain (earlier chain, length, copies); packs are kept by fill.
    by_fill: dict[int, list[list]] = defaultdict(list)
    heap: list[int] = []

    def put(fill: int, chain: tuple, count: int) -> None:
        if not by_fill[fill]:
            heapq.heappush(heap, fill)
        by_fill[fill].append([chain, count])

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            while heap and not by_fill[heap[0]]:
                heapq.heappop(heap)
            if heap and heap[0] + length <= limit:
                fill = heap[0]
                chain, count = by_fill[fill].pop()
                if not by_fill[fill]:
                    heapq.heappop(heap)
                placed = min(count, left)
                if count > placed:
                    put(fill, chain, count - placed)
                put(fill + length, (chain, length, 1), placed)
                left -= placed
            else:
                # The new pack is the shortest one that fits, until it is full.
                copies = limit // length
                full, rest = divmod(left, copies)
                if full:
                    put(copies * length, (None, length, copies), full)
                if rest:
                    put(rest * length, (None, length, rest), 1)
                left = 0
    out = []
    for fill in sorted(by_fill):
        for chain, count in by_fill[fill]:
            lengths: list[int] = []
            while chain is not None:
                chain, length, copies = chain
                lengths += [length] * copies
            out.append((count, lengths[::-1]))
    return out


def slots(patterns: list[tuple[int, list[int]]]) -> dict[int, np.ndarray]:
    """By length: rows (first rank, first sequence, offset) in order of rank."""
    used, sequence, out = Counter(), 0, defaultdict(list)
    for count, lengths in patterns:
        offset = 0
        for length in lengths:
            out[length].append((used[length], sequence, offset))
            used[length] += count
            offset += length
        sequence += count
    return {length: np.array(rows, np.int64) for length, rows in out.items()}


def pack(docs: DataFrame, vocabulary: str | None = None, end_id: int = END_ID, limit: int = LIMIT) -> DataFrame:
    """``(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset)`` per piece."""
    cut = materialize(pieces(docs, vocabulary or public_tokenizers.path(VOCABULARY), end_id, limit), "packing-pieces")
    counts = materialize(cut.groupBy("task", "length").agg(F.count("*").alias("n")), "packing-counts")
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places = slots(pack_lengths(histogram, limit))
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("task", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    ranked = cut.join(before, ["task", "length"]).withColumn("rank", F.col("nth") + F.col("before"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            sequence, offset = np.empty(len(rank), np.int64), np.empty(len(rank), np.int64)
            order = np.argsort(length, kind="stable")
            bounds = np.flatnonzero(np.diff(length[order])) + 1
            for rows in np.split(order, bounds) if len(order) else []:
                place = places[int(length[rows[0]])]
                k = np.searchsorted(place[:, 0], rank[rows], "right") - 1
                sequence[rows] = place[k, 1] + rank[rows] - place[k, 0]
                offset[rows] = place[k, 2]
            kept = [batch.column(c) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(offset)], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    return ranked.mapInArrow(tidied(run), "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")


def query(docs: DataFrame) -> DataFrame:
    return pack(docs)
