"""Counts of all contexts of the mixing model, dealt over Spark by context hash.

A *chunk* is a bounded number of distinct tokens or borders with their numbers in the
training texts (0: only scored).  Its distinct events ask, in each of the contexts, for
how often the event's byte and those that share its first bits followed: an *entry* is
56 bits of the context's hash and the byte.  Entries are dealt by hash to shards, whose
number grows with the tokens.  A shard adds up its entries over all chunks and answers
each; chunks then hold the exact counts of their own contexts, and no table of all
contexts is in one place.

The mixer learns online in one pass: each chunk from its first event to its last, every
training byte with its number and predicted from the others; the chunks' mixers are then
merged by what each has seen.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from burnlens.llm import mixing
from burnlens.llm.common import materialize, tidied
from burnlens.llm.mixing import CLASS_OF, CLASS_ORDERS, EVENTS_AT_ONCE, NOTHING, ORDERS, PRIOR, STEP_EVENTS, SUMMARY, TOKEN, Learner, Mixer, bits, packed, rests, unpacked
from burnlens.llm.wordhash import mixed, prefix_sums, stretch_hash

#: Tokens of one chunk, and entries of one shard (about).
CHUNK_TOKENS, SHARD_ENTRIES = 60_000, 1_000_000
BYTE = np.uint64(0xFF)
BALANCED = np.float32(1e-4)

_A, _B, _C = mixing._A, mixing._B, mixing._C


def _row(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in columns.values()], names=list(columns))


def entry_codes(window: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Entries (contexts x events): 56 bits of the context's hash, and the byte."""
    out = np.empty((ORDERS, len(window)), np.uint64)
    for order in range(ORDERS):
        context = word if order == ORDERS - 1 else (window >> np.uint64(8)) & np.uint64((1 << (8 * (order + 1))) - 1)
        if order in CLASS_ORDERS:
            context = context + (window >> np.uint64(48)) * _A
        out[order] = mixed(context * _B + np.uint64(order)) & ~BYTE | window & BYTE
    return out


def distinct(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct numbers, a place of each (any, unlike ``np.unique``), and every number's rank."""
    order = np.argsort(a)
    held = a[order]
    fresh = np.ones(len(a), bool)
    fresh[1:] = held[1:] != held[:-1]
    back = np.empty(len(a), np.int32)
    back[order] = np.cumsum(fresh, dtype=np.int32) - np.int32(1)
    return held[fresh], order[fresh], back


class Chunk:
    def __init__(self, kind: int, keys: list[bytes], number: np.ndarray) -> None:
        if kind == TOKEN:
            window, word, self.of = rests([k[1:] for k in keys], np.array([CLASS_OF[k[:1]] for k in keys], np.uint64))
        else:
            window = np.frombuffer(b"".join(keys), np.uint64)
            word, self.of = np.repeat(NOTHING, len(keys)), np.arange(len(keys))
        self.size = len(keys)
        _, at, self.back = distinct(mixed(window * _A + word))
        self.window, self.word = window[at], word[at]
        self.weight = np.bincount(self.back, number[self.of], len(at))
        self.codes, _, index = distinct(entry_codes(self.window, self.word).ravel())
        self.index = index.reshape(ORDERS, -1)

    def numbers(self) -> np.ndarray:
        """The entries' numbers here."""
        return np.bincount(self.index.ravel(), np.tile(self.weight, ORDERS), len(self.codes)).astype(np.int64)

    def parts(self, counts: np.ndarray, trained: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """``(events, inputs)`` in bounded parts, in the order of the events' hashes;
        ``trained``: the training bytes, each predicted from the others."""
        events = np.flatnonzero(self.weight > 0) if trained else np.arange(len(self.window))
        value, size = entry_inputs(counts, trained), STEP_EVENTS if trained else EVENTS_AT_ONCE
        for k in range(0, len(events), size):
            at = events[k : k + size]
            x = value[self.index[:, at]]
            np.negative(x, out=x, where=~bits(self.window[at]))
            np.copyto(x, BALANCED, where=x == -BALANCED)
            yield at, x

    def log2(self, counts: np.ndarray, mixer: Mixer) -> np.ndarray:
        """log2 probability of each token (but its first byte) or border."""
        out = np.empty(len(self.window))
        for at, x in self.parts(counts, False):
            p = np.clip(mixer.refined(mixer.mix(x)[1]), 1e-6, 1 - 1e-6)
            out[at] = np.log2(np.where(bits(self.window[at]), p, 1 - p)).sum(1)
        return np.bincount(self.of, out[self.back], self.size)


def entry_inputs(counts: np.ndarray, others: bool) -> np.ndarray:
    """Inputs (entries x 8) for the entry's own bits, 0 where the context is unknown."""
    c = np.maximum(counts - 1, 0) if others else counts
    out = np.zeros((8, counts.shape[1]), np.float32)
    for k in range(8):
        known = np.flatnonzero(c[k])
        both, ones = c[k][known], c[k + 1][known]
        value = np.log((ones + PRIOR) / (both - ones + PRIOR)).astype(np.float32)
        value[value == 0] = BALANCED
        out[k][known] = value
    return np.ascontiguousarray(out.T)


def branch_counts(codes: np.ndarray, number: np.ndarray) -> np.ndarray:
    """For distinct sorted entries: how often bytes that share the entry's first 0 to 8 bits followed its context."""
    out = np.empty((9, len(codes)), np.int64)
    for k in range(9):
        node = codes >> np.uint64(8 - k)
        first = np.concatenate([[True], node[1:] != node[:-1]])
        out[k] = np.add.reduceat(number, np.flatnonzero(first))[np.cumsum(first) - 1]
    return out


def answered(asked: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[np.ndarray]:
    """Counts (9 x entries) for each of a shard's ``(codes, numbers)``."""
    codes, back = np.unique(np.concatenate([c for c, _ in asked]), return_inverse=True)
    number = np.zeros(len(codes), np.int64)
    np.add.at(number, back, np.concatenate([n for _, n in asked]))
    counts, at = branch_counts(codes, number), 0
    for c, _ in asked:
        yield counts[:, back[at : at + len(c)]]
        at += len(c)


def packed_keys(keys: list[bytes]) -> tuple[bytes, bytes]:
    return packed(np.array([len(k) for k in keys], np.int64)), packed(np.frombuffer(b"".join(keys), np.uint8))


def unpacked_keys(sizes: bytes, data: bytes) -> list[bytes]:
    ends = np.cumsum(unpacked(sizes, np.int64))
    raw = unpacked(data, np.uint8).tobytes()
    return [raw[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]


def chunks(counts: DataFrame) -> DataFrame:
    """``(source, kind, sizes, keys, n)``: neighbours in key order, so that they share contexts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[list[bytes], list[int]]] = {}

        def close(kind: int) -> pa.RecordBatch:
            keys, number = held.pop(kind)
            sizes, data = packed_keys(keys)
            return _row(kind=(kind, pa.int32()), sizes=(sizes, pa.binary()), keys=(data, pa.binary()), n=(packed(np.array(number, np.int64)), pa.binary()))

        for batch in batches:
            for kind, key, n in zip(*(batch.column(c).to_pylist() for c in ("kind", "key", "n"))):
                keys, number = held.setdefault(kind, ([], []))
                keys.append(key)
                number.append(n)
                if len(keys) >= CHUNK_TOKENS:
                    yield close(kind)
        for kind in sorted(held):
            yield close(kind)

    rows = counts.where(F.col("kind").isin(mixing.TOKEN, mixing.BORDER)).select("kind", "key", "n")
    rows = rows.repartitionByRange("kind", "key").sortWithinPartitions("kind", "key")
    return rows.mapInArrow(tidied(run), "kind int, sizes binary, keys binary, n binary").withColumn("source", F.monotonically_increasing_id())


def _chunk(row: dict) -> Chunk:
    return Chunk(row["kind"], unpacked_keys(row["sizes"], row["keys"]), unpacked(row["n"], np.int64))


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for k in range(batch.num_rows):
            yield {c: batch.column(j)[k].as_py() for j, c in enumerate(batch.schema.names)}


def shard_bits(key_bytes: int) -> int:
    """From the bytes of all distinct keys: each is an event at most, in two or three contexts of its own."""
    return max(0, int(np.ceil(np.log2(max(3 * key_bytes / SHARD_ENTRIES, 1)))))


def with_counts(made: DataFrame, n_bits: int, tasks: int) -> DataFrame:
    """The chunks with the counts of their entries (``shards``: a list in the entries' order)."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            chunk = _chunk(row)
            number = chunk.numbers()
            cuts = np.searchsorted(chunk.codes >> np.uint64(32), np.arange((1 << n_bits) + 1, dtype=np.uint64) << np.uint64(32 - n_bits))
            for shard, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
                if a < b:
                    codes = np.diff(chunk.codes[a:b], prepend=np.uint64(0))
                    yield _row(shard=(shard, pa.int32()), source=(row["source"], pa.int64()), codes=(packed(codes), pa.binary()), n=(packed(number[a:b]), pa.binary()))

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []

        def close() -> Iterator[pa.RecordBatch]:
            for (source, _, _), counts in zip(held, answered([(c, n) for _, c, n in held])):
                # What each bit leaves behind is mostly 0.
                left = np.concatenate([counts[:-1] - counts[1:], counts[-1:]])
                yield _row(shard=(now, pa.int32()), source=(source, pa.int64()), data=(packed(left.ravel()), pa.binary()))
            held.clear()

        for row in _rows(batches):
            if row["shard"] != now:
                if held:
                    yield from close()
                now = row["shard"]
            held.append((row["source"], np.cumsum(unpacked(row["codes"], np.uint64), dtype=np.uint64), unpacked(row["n"], np.int64)))
        if held:
            yield from close()

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by source, the chunk itself first."""
        own, shards = None, []

        def close() -> pa.RecordBatch:
            return _row(**{c: (own[c], t) for c, t in types.items()}, shards=(shards, pa.list_(pa.binary())))

        types = {"source": pa.int64(), "kind": pa.int32(), "sizes": pa.binary(), "keys": pa.binary(), "n": pa.binary()}
        for row in _rows(batches):
            if row["shard"] < 0:
                if own:
                    yield close()
                own, shards = row, []
            else:
                shards.append(row["data"])
        if own:
            yield close()

    asked = made.mapInArrow(tidied(ask), "shard int, source long, codes binary, n binary")
    answers = asked.repartition(max(1 << n_bits, 1), "shard").sortWithinPartitions("shard", "source").mapInArrow(tidied(answer), "shard int, source long, data binary")
    both = made.withColumn("shard", F.lit(-1)).unionByName(answers, allowMissingColumns=True)
    dealt = both.repartition(tasks, "source").sortWithinPartitions("source", "shard")
    return dealt.mapInArrow(tidied(gather), "source long, kind int, sizes binary, keys binary, n binary, shards array<binary>")


def _with_counts(row: dict) -> tuple[Chunk, np.ndarray]:
    """A chunk and its entries' counts (9 x entries)."""
    left = [unpacked(s, np.int64).reshape(9, -1) for s in row["shards"]]
    left = np.concatenate(left, 1) if left else np.zeros((9, 0), np.int64)
    return _chunk(row), np.cumsum(left[::-1], axis=0)[::-1]


def learned(chunk: Chunk, counts: np.ndarray) -> np.ndarray:
    """What the mixer learns online from a chunk's training bytes."""
    learner = Learner()
    for at, x in chunk.parts(counts, True):
        learner.step(x, bits(chunk.window[at]), chunk.weight[at])
    return learner.summary()


def _summed(full: DataFrame, work, size: int) -> np.ndarray:
    """The sum of ``work(chunk, counts)`` over all chunks (a few thousand numbers)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for row in _rows(batches):
            one = work(*_with_counts(row)).ravel()
            total = one if total is None else total + one
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total)), pa.int32()), pa.array(total)], names=["k", "v"])

    rows = full.mapInArrow(tidied(run), "k int, v double").groupBy("k").agg(F.sum("v").alias("v")).collect()
    out = np.zeros(size)
    for r in rows:
        out[r.k] = r.v
    return out


def train_mixer(full: DataFrame) -> Mixer:
    return Learner.merged(_summed(full, learned, SUMMARY))


def key_scores(full: DataFrame, mixer: Mixer) -> DataFrame:
    """``(h, word, n, value)`` of every token and border: its hash in texts, that of its word, its number, its log2 probability."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            chunk, counts = _with_counts(row)
            keys, n = unpacked_keys(row["sizes"], row["keys"]), unpacked(row["n"], np.int64)
            if row["kind"] == TOKEN:
                size = np.array([len(k) for k in keys], np.int64)
                sums, end = prefix_sums(np.frombuffer(b"".join(keys), np.uint8)), np.cumsum(size)
                start = end - size + 1
                h = stretch_hash(sums, start, end) + np.array([k[0] for k in keys], np.uint64) * _C
                word = pa.array(stretch_hash(sums, start, end - 1).view(np.int64), mask=size <= 2)
            else:
                h = mixed(np.frombuffer(b"".join(keys), np.uint64))
                word = pa.nulls(len(keys), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), word, pa.array(n), pa.array(chunk.log2(counts, mixer))], names=["h", "word", "n", "value"])

    return full.mapInArrow(tidied(run), "h long, word long, n long, value double")


def counted_chunks(counts: DataFrame) -> DataFrame:
    """All chunks with the exact counts of their contexts, written."""
    spark = counts.sparkSession
    size = counts.agg(F.sum(F.length("key")).alias("n")).first().n or 0
    n_bits = shard_bits(size)
    made = materialize(chunks(counts), "lm-chunks")
    return materialize(with_counts(made, n_bits, max(1 << n_bits, 2 * spark.sparkContext.defaultParallelism)), "lm-contexts")
