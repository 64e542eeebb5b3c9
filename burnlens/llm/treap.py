"""Ranked lexical search over a K2-treap of the term-document grid.

1. A first pass counts the documents and their terms (the impacts need both numbers).
2. Documents are cut into ranges of at most ``RANGE_DOCUMENTS`` (or ``RANGE_POSTINGS``).
   A range's grid has its terms as rows, the frequent ones first, and its documents as
   columns, short ones first; strips of as many rows as columns are quadtrees.  A cell
   holds the largest impact in it, kept as the difference to that of the cell around
   it, and which of its quarters are not empty; a cell with a single posting is not
   divided further but names it.  Ranges are written as one row each.
3. Document frequencies of the items' terms are added up over the ranges.
4. An item's terms are row paths.  They descend jointly: a state is a span of columns
   with the cell of every path there, and its bound is the sum of the terms' weights
   times the maxima of their cells.  The states with the highest bounds are split
   first; a span of one document has its exact score.  A state whose bound is below
   the ``k``-th best score that the task has found so far is done with.
5. The ranges' best are merged in two levels.

Impacts, weights and scores are 64-bit integers, the same in any range and order.

Defined cases: rows without an id take no part; a null or empty text has no terms, and
such a document or item is never ranked; repeated documents are ranked each for itself;
rows of ``items`` with one id make one item, each term counted once; ties go to the
smaller ``doc_id``; texts of any length are taken whole; empty tables give no rows;
extra columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from burnlens.llm.common import documents, in_steps, map_arrow, materialize, small_batches, texts, tidied

TOP = 50
#: Limits of one range of documents.
RANGE_DOCUMENTS, RANGE_POSTINGS = 4096, 1 << 20
#: Items, and terms of items, that are searched together.
BLOCK_ITEMS, BLOCK_TERMS = 512, 100_000
#: States that are split together, and cells of open states beyond which the deepest go first.
SPLIT, OPEN_CELLS = 256, 1 << 23
#: First level of the merge: so many parts an item.
MERGE_PARTS = 32

SEPARATORS = bytes([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])  # ASCII but letters and digits
#: Letters A-Z become small, separators spaces.
FOLD = bytes.maketrans(bytes(range(0x41, 0x5B)) + SEPARATORS, bytes(range(0x61, 0x7B)) + b" " * len(SEPARATORS))
INDEX = "documents int, bits int, terms binary, dfs binary, doc_ids binary, strips binary, masks binary, maxima binary, points binary"
FOUND = "item_id long, doc_id long, score long"
POP = np.array([m.bit_count() for m in range(16)], np.int64)


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split()


def length_norm(n: np.ndarray, total_documents: int, total_terms: int) -> np.ndarray:
    return 100 - 50 + (50 * n * total_documents) // total_terms


def impacts(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


def weight(total_documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * total_documents + 2) / (2 * df + 1)))


def spread(x: np.ndarray) -> np.ndarray:
    """Bits of ``x`` (16 at most) with a gap after each."""
    x = x.astype(np.int64)
    for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
        x = (x | (x << shift)) & mask
    return x


def packed(x: np.ndarray) -> bytes:
    return zstandard.compress(np.ascontiguousarray(x).tobytes(), 1)


def unpacked(data: bytes, dtype: type) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(data), dtype)


@dataclass
class Treap:
    """The cells of one range, level by level; the last entry of each array is the empty cell.

    ``first`` numbers a cell's first child; ``row`` and ``col`` are of the one posting of an
    undivided cell (``mask`` 0), the row within its strip.
    """

    bits: int
    strips: np.ndarray
    mask: np.ndarray
    first: np.ndarray
    top: np.ndarray
    row: np.ndarray
    col: np.ndarray

    @property
    def none(self) -> int:
        return len(self.mask) - 1

    def at(self, cells: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """The cells, but empty where the one posting is in another row."""
        return np.where((self.mask[cells] == 0) & (self.row[cells] != rows), self.none, cells)

    def roots(self, rows: np.ndarray) -> np.ndarray:
        """Top cells of the rows' strips."""
        strip = rows >> self.bits
        at = np.minimum(np.searchsorted(self.strips, strip), len(self.strips) - 1)
        return self.at(np.where(self.strips[at] == strip, at, self.none), rows & ((1 << self.bits) - 1))

    def quarters(self, cells: np.ndarray, rows: np.ndarray, shift: np.ndarray, span: np.ndarray, half: int) -> np.ndarray:
        """For states ``cells`` (states x terms), the cells of the given half of their columns."""
        mask = self.mask[cells]
        q = 2 * (rows >> shift & 1) + half
        child = self.first[cells] + POP[mask & ((1 << q) - 1)]
        child = np.where(mask >> q & 1, child, self.none)
        stays = np.where(self.col[cells] >> shift == 2 * span + half, cells, self.none)
        return self.at(np.where(mask > 0, child, stays), rows)


def cells(row: np.ndarray, col: np.ndarray, value: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Strips, masks, maxima (differences to the parent's) and points of the undivided
    cells, all in level order."""
    low = (1 << bits) - 1
    code = (row >> bits << 2 * bits) | (spread(row & low) << 1) | spread(col)
    order = np.argsort(code, kind="stable")
    code, value, point = code[order], value[order], ((row & low) << bits | col)[order]
    strips = np.unique(code >> 2 * bits)
    masks, maxima, points = [], [], []
    above = None
    for level in range(bits + 1):
        cell = code >> 2 * (bits - level)
        starts = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
        sizes = np.diff(np.append(starts, len(cell)))
        top = np.maximum.reduceat(value, starts)
        if level:
            quarter = cell[starts]
            family = np.flatnonzero(np.concatenate([[True], quarter[1:] >> 2 != quarter[:-1] >> 2]))
            inner = np.flatnonzero(divided)
            masks[-1][inner] = np.bitwise_or.reduceat((1 << (quarter & 3)).astype(np.uint8), family)
            maxima.append(np.repeat(above[inner], np.diff(np.append(family, len(quarter)))) - top)
        else:
            maxima.append(top)
        divided, above = sizes > 1, top
        masks.append(np.zeros(len(starts), np.uint8))
        points.append(point[starts[~divided]])
        left = np.repeat(divided, sizes)
        code, value, point = code[left], value[left], point[left]
        if not len(code):
            break
    return strips, np.concatenate(masks), np.concatenate(maxima), np.concatenate(points)


def opened(row: dict) -> Treap:
    """The cells of an index row."""
    bits = row["bits"]
    strips = unpacked(row["strips"], np.int32).astype(np.int64)
    mask, drop, point = unpacked(row["masks"], np.uint8), unpacked(row["maxima"], np.int32), unpacked(row["points"], np.int32)
    children = POP[mask]
    first = len(strips) + np.cumsum(children) - children
    top = np.empty(len(mask), np.int64)
    at, size = 0, len(strips)
    top[:size] = drop[:size]
    while at + size < len(mask):
        more = int(children[at : at + size].sum())
        top[at + size : at + size + more] = np.repeat(top[at : at + size], children[at : at + size]) - drop[at + size : at + size + more]
        at, size = at + size, more
    row_of, col_of = np.full((2, len(mask) + 1), -1, np.int32)
    alone = np.flatnonzero(mask == 0)
    row_of[alone], col_of[alone] = point >> bits, point & ((1 << bits) - 1)
    row_of[-1] = -2
    return Treap(bits, strips, np.append(mask, 0).astype(np.int64), np.append(first, 0), np.append(top, 0), row_of, col_of)


def best_documents(treap: Treap, rows: np.ndarray, weights: np.ndarray, doc_ids: np.ndarray, held: tuple[np.ndarray, np.ndarray], k: int) -> tuple[np.ndarray, np.ndarray]:
    """``held`` (scores, ids; the ``k`` best so far) merged with the range's documents."""
    scores, ids = held
    local = rows & ((1 << treap.bits) - 1)
    open_cells = treap.roots(rows)[None, :]
    bound = treap.top[open_cells] @ weights
    level, span = np.zeros(1, np.int64), np.zeros(1, np.int64)
    while True:
        least = scores[-1] if len(scores) == k else 1
        live = bound >= least
        if not live.all():
            open_cells, bound, level, span = open_cells[live], bound[live], level[live], span[live]
        if not len(bound):
            return scores, ids
        if len(bound) > SPLIT:
            key = level if open_cells.size > OPEN_CELLS else bound
            pick = np.zeros(len(bound), bool)
            pick[np.argpartition(key, len(key) - SPLIT)[-SPLIT:]] = True
        else:
            pick = np.ones(len(bound), bool)
        c, l, s = open_cells[pick], level[pick], span[pick]
        shift = (treap.bits - 1 - l)[:, None]
        halves = [treap.quarters(c, local, shift, s[:, None], half) for half in (0, 1)]
        c = np.concatenate(halves)
        b, l, s = treap.top[c] @ weights, np.concatenate([l, l]) + 1, np.concatenate([2 * s, 2 * s + 1])
        live = b >= least
        c, b, l, s = c[live], b[live], l[live], s[live]
        done = l == treap.bits
        if done.any():
            scores, ids = np.concatenate([scores, b[done]]), np.concatenate([ids, doc_ids[s[done]]])
            order = np.lexsort((ids, -scores))[:k]
            scores, ids = scores[order], ids[order]
        open_cells, bound, level, span = (np.concatenate([old[~pick], new[~done]]) for old, new in zip((open_cells, bound, level, span), (c, b, l, s)))


@dataclass
class Index:
    ranges: DataFrame
    documents: int
    terms: int


def totals(docs: DataFrame) -> tuple[int, int]:
    """Documents with a term, and terms with repeats."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        n = [len(terms_of(t)) for t in texts(batch.column("text"))]
        return pa.RecordBatch.from_arrays([pa.array([sum(map(bool, n))]), pa.array([sum(n)])], names=["n", "l"])

    n, size = map_arrow(docs, run, "n long, l long").agg(F.sum("n"), F.sum("l")).first()
    return n or 0, size or 0


def build(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", range_documents: int = RANGE_DOCUMENTS, range_postings: int = RANGE_POSTINGS) -> Index:
    """Index every row of ``docs``."""
    small_batches(docs.sparkSession)
    docs = documents(docs, id_col=id_col, text_col=text_col).where("doc_id IS NOT NULL")
    n_documents, n_terms = totals(docs)

    def range_row(ids: list[int], parts: list[np.ndarray], words: list[bytes]) -> pa.RecordBatch:
        sizes = np.array([len(p) for p in parts])
        order = np.argsort(sizes, kind="stable")
        sizes, doc_ids = sizes[order], np.array(ids, np.int64)[order]
        bits = max(1, (len(order) - 1).bit_length())
        key = np.concatenate([parts[k] for k in order]) | np.repeat(np.arange(len(order)), sizes) << 32
        key, tf = np.unique(key, return_counts=True)
        col, word = key >> 32, key & 0xFFFFFFFF
        # Frequent terms first, then by their first document.
        used, start, back, df = np.unique(word, return_index=True, return_inverse=True, return_counts=True)
        rank = np.lexsort((start, -df))
        place = np.empty(len(used), np.int64)
        place[rank] = np.arange(len(used))
        value = impacts(tf, length_norm(sizes, n_documents, n_terms)[col])
        strips, masks, maxima, points = cells(place[back], col, value, bits)
        spelled = zstandard.compress(b" ".join(words[k] for k in used[rank]), 1)
        binary = [spelled, *(packed(x) for x in (df[rank].astype(np.int32), doc_ids, strips.astype(np.int32), masks, maxima.astype(np.int32), points.astype(np.int32)))]
        return pa.RecordBatch.from_arrays(
            [pa.array([len(order)], pa.int32()), pa.array([bits], pa.int32()), *(pa.array([b], pa.binary()) for b in binary)],
            names=["documents", "bits", "terms", "dfs", "doc_ids", "strips", "masks", "maxima", "points"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number: dict[bytes, int] = {}
        words: list[bytes] = []
        ids: list[int] = []
        parts: list[np.ndarray] = []
        size = 0

        def of(term: bytes) -> int:
            n = number.get(term)
            if n is None:
                n = number[term] = len(words)
                words.append(term)
            return n

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts(batch.column("text"))):
                found = terms_of(text)
                if not found:
                    continue
                if parts and (len(parts) >= range_documents or size + len(found) > 2 * range_postings):
                    yield range_row(ids, parts, words)
                    number, words, ids, parts, size = {}, [], [], [], 0
                parts.append(np.fromiter(map(of, found), np.int64, len(found)))
                ids.append(doc_id)
                size += len(found)
        if parts:
            yield range_row(ids, parts, words)

    return Index(materialize(docs.mapInArrow(tidied(run), INDEX), "treap-ranges"), n_documents, n_terms)


def item_terms(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``(item_id, terms array<string>)``: each item's terms, once."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [[t.decode() for t in set(terms_of(x))] for x in texts(batch.column("text"))]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.list_(pa.string()))], names=["item_id", "terms"])

    rows = map_arrow(documents(items, id_col=id_col, text_col=text_col).where("doc_id IS NOT NULL"), run, "item_id long, terms array<string>")
    return rows.select("item_id", F.explode("terms").alias("term")).distinct().groupBy("item_id").agg(F.collect_list("term").alias("terms"))


def document_frequencies(index: Index, wanted: list[str]) -> dict[str, int]:
    """Documents that hold each of the wanted terms (those of one block of items)."""
    want = pa.array([t.encode() for t in wanted], pa.binary())

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        total = np.zeros(len(want), np.int64)
        for spelled, dfs in zip(batch.column("terms").to_pylist(), batch.column("dfs").to_pylist()):
            at = pc.index_in(want, value_set=pa.array(zstandard.decompress(spelled).split(b" "), pa.binary()))
            there = np.flatnonzero(at.is_valid().to_numpy(zero_copy_only=False))
            total[there] += unpacked(dfs, np.int32)[at.drop_null().to_numpy()]
        live = np.flatnonzero(total)
        return pa.RecordBatch.from_arrays([want.take(pa.array(live)).cast(pa.string()), pa.array(total[live])], names=["term", "df"])

    found = map_arrow(index.ranges.select("terms", "dfs"), run, "term string, df long").groupBy("term").agg(F.sum("df").alias("df"))
    return {r.term: r.df for r in found.collect()}


def block_best(index: Index, block: list[tuple[int, list[str]]], k: int) -> DataFrame:
    """Each task's best documents for each item of the block."""
    vocabulary = sorted({t for _, terms in block for t in terms})
    dfs = document_frequencies(index, vocabulary)
    number = {t: n for n, t in enumerate(vocabulary)}
    want = pa.array([t.encode() for t in vocabulary], pa.binary())
    weights = np.array([weight(index.documents, dfs[t]) if t in dfs else 0 for t in vocabulary], np.int64)
    asked = [(i, np.array([number[t] for t in terms], np.int64)) for i, terms in block]
    asked = [(i, t[weights[t] > 0]) for i, t in asked]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {i: (np.zeros(0, np.int64), np.zeros(0, np.int64)) for i, _ in asked}
        for batch in batches:
            for n in range(batch.num_rows):
                row = batch.slice(n, 1).to_pylist()[0]
                at = pc.index_in(want, value_set=pa.array(zstandard.decompress(row["terms"]).split(b" "), pa.binary()))
                rows = pc.fill_null(at, -1).to_numpy().astype(np.int64)
                treap, doc_ids = opened(row), unpacked(row["doc_ids"], np.int64)
                for i, terms in asked:
                    here = terms[rows[terms] >= 0]
                    if len(here):
                        held[i] = best_documents(treap, rows[here], weights[here], doc_ids, held[i], k)
        for i, (scores, ids) in held.items():
            if len(ids):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), i, np.int64)), pa.array(ids), pa.array(scores)], names=["item_id", "doc_id", "score"])

    return index.ranges.mapInArrow(tidied(run), FOUND)


def best(rows: DataFrame, k: int, *keys: str) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "doc_id")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(index: Index, items: DataFrame, k: int = TOP, id_col: str = "item_id", text_col: str = "text", block_items: int = BLOCK_ITEMS, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: each item's ``k`` best documents."""
    asked = materialize(item_terms(items, id_col, text_col), "treap-items")
    n, size = asked.agg(F.count("*"), F.sum(F.size("terms"))).first()
    blocks = max(1, -(-n // block_items), -(-(size or 0) // block_terms))

    def found() -> Iterator[DataFrame]:
        for b in range(blocks):
            # About block_items rows and block_terms terms each, whatever the table's size.
            block = [(r.item_id, list(r.terms)) for r in asked.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b).collect()]
            if block and index.documents:
                rows = block_best(index, block, k).withColumn("part", F.pmod(F.spark_partition_id(), F.lit(MERGE_PARTS)))
                rows = best(rows, k, "item_id", "part").select("item_id", "doc_id", "score")
                yield best(rows, k, "item_id").select("item_id", "rank", "doc_id", "score")

    out = in_steps(found(), "treap-found")
    if out is None:
        return asked.select("item_id", F.lit(0).alias("rank"), F.col("item_id").alias("doc_id"), F.col("item_id").alias("score")).where("false")
    return out


def query(docs: DataFrame, items: DataFrame) -> DataFrame:
    return search(build(docs), items)


SQL = r"""
WITH t AS (
  SELECT r, doc_id, n, unnest(w) AS term
  FROM (
    SELECT r, doc_id, w, len(w) AS n
    FROM (
      SELECT row_number() OVER () AS r, CAST(doc_id AS BIGINT) AS doc_id,
             regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
      FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL
    )
  )
), d AS (
  SELECT count(*) AS documents, sum(len(w)) AS terms
  FROM (SELECT regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL)
  WHERE len(w) > 0
), f AS (
  SELECT r, doc_id, n, term, count(*) AS tf FROM t GROUP BY r, doc_id, n, term
), w AS (
  SELECT term, CAST(floor(1000 * ln((2 * documents + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM f, d GROUP BY term, documents
), i AS (
  SELECT DISTINCT CAST(item_id AS BIGINT) AS item_id,
         unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark WHERE item_id IS NOT NULL
), s AS (
  SELECT i.item_id, f.doc_id,
         CAST(sum(w.w * ((1000000000 * f.tf) // (1000 * f.tf + 20 * (100 - 50 + CAST((50 * f.n * d.documents) // d.terms AS BIGINT))))) AS BIGINT) AS score
  FROM i JOIN f USING (term) JOIN w USING (term), d
  GROUP BY i.item_id, f.r, f.doc_id
), r AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM s WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 50
"""
