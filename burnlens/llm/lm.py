"""Language-model scores of whole texts: word frequencies and logistic context mixing.

Base score: sum over a text's words and its end of
``log10((c + 0.1) / (N + 0.1 (V + 1)))`` with the token's count, all tokens and
distinct tokens of the training texts.  Score: log10 probability under the mixing
model (``mixing``); ``bits_per_byte`` is the same for each byte and the end.

1. One pass over all texts: every task counts its distinct tokens and the borders
   between them, by their numbers in the training texts (0 in held-out ones alone).
   The counts are summed by a shuffle and written once.
2. The contexts of tokens and borders are counted exactly, dealt over Spark by their
   hash (``contexts``); what is gathered grows with the distinct contexts.  The mixer
   learns online from all training bytes by their numbers, and every distinct token
   and border is scored.
3. A second pass over all texts: tokens and borders among the ``HEAD_WORDS`` most
   frequent are looked up where they stand.  The others of each text are joined with
   their scores by a shuffle, so there may be any number.

Defined cases: a null or empty text is its end alone; repeated rows are learned
from and scored once each; a null ``doc_id`` is kept and never held out; without
training texts every token has base probability 1 and every bit 1/2; an empty
table gives no rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from burnlens.llm import contexts, mixing
from burnlens.llm.common import documents, map_arrow, materialize, texts, tidied
from burnlens.llm.labelled import held_out
from burnlens.llm.wordhash import HashTable, prefix_sums, stretch_hash

#: Most frequent tokens and borders that go to every task (about, never more); the rest are joined.
HEAD_WORDS, HEAD_TABLE_BITS = 400_000, 21
#: Steps of the frequency scale by which the head is cut, for each doubling.
SCALE = 16

DOCUMENTS = 3  # kind of the row that counts documents


def _rows(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in columns.values()], names=list(columns))


def counted(docs: DataFrame) -> DataFrame:
    """``(kind, key, n)``: tokens and borders of ``docs(text, train)`` with their numbers in the
    training texts, and the number of these."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters, n = (mixing.Counter(), mixing.Counter()), 0

        def close(train: int) -> Iterator[pa.RecordBatch]:
            for kind, keys, number in counters[train].rows():
                for k in range(0, len(keys), 1 << 16):
                    part = keys[k : k + (1 << 16)]
                    yield _rows(kind=([kind] * len(part), pa.int32()), key=(part, pa.binary()), n=(number[k : k + (1 << 16)] * train, pa.int64()))

        for batch in batches:
            train = batch.column("train")
            n += train.true_count
            for k, rows in enumerate((pc.invert(train), train)):
                for _, _, stream, begin in mixing.streams(texts(batch.column("text").filter(rows))):
                    counters[k].add(stream, begin)
                    if counters[k].full():
                        yield from close(k)
        for k in range(2):
            yield from close(k)
        yield _rows(kind=([DOCUMENTS], pa.int32()), key=([b""], pa.binary()), n=([n], pa.int64()))

    return docs.select("text", "train").mapInArrow(tidied(run), "kind int, key binary, n long").groupBy("kind", "key").agg(F.sum("n").alias("n"))


def vocabulary_of(counts: DataFrame) -> DataFrame:
    """``(h, n)`` of the distinct words of the training texts."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        h, n = mixing.word_counts(batch.column("key").to_pylist(), batch.column("n").to_numpy())
        return _rows(h=(h.view(np.int64), pa.int64()), n=(n, pa.int64()))

    return map_arrow(counts.where((F.col("kind") == mixing.TOKEN) & (F.col("n") > 0)).select("key", "n"), run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))


def with_base(scores: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """``(h, n, value, base, known)``: with the base model's term for the token's word, and whether it is known."""
    found = scores.join(vocabulary.select(F.col("h").alias("word"), F.col("n").alias("word_n")), "word", "left")
    base = F.when(F.col("word").isNull(), 0.0).otherwise(F.log10(F.coalesce("word_n", F.lit(0)) + 0.1))
    return found.select("h", "n", "value", base.alias("base"), F.col("word_n").isNotNull().cast("int").alias("known"))


def head_keys(table: DataFrame) -> pa.Table:
    """The rows above a number that ``HEAD_WORDS`` at most reach, rarest first."""
    step = F.floor(F.log2(F.greatest("n", F.lit(1))) * SCALE).cast("int")
    sizes = table.groupBy(step.alias("step")).agg(F.count("*").alias("words")).collect()
    cut, total = None, 0
    for r in sorted(sizes, key=lambda r: -r.step):
        total += r.words
        if total > HEAD_WORDS:
            break
        cut = r.step
    top = table.where(F.lit(False) if cut is None else step >= cut).toArrow()
    return top.sort_by([("n", "ascending"), ("h", "ascending")])


def scored(docs: DataFrame, head: pa.Table) -> DataFrame:
    """The head's share of the sums of every text, and the tokens and borders that are left."""
    head_h = head.column("h").to_numpy().view(np.uint64)
    # The last row is what isn't in the head.
    head_value, head_base, head_known = (np.append(head.column(c).to_numpy(), 0) for c in ("value", "base", "known"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = HashTable(HEAD_TABLE_BITS)
        table.put(head_h, np.arange(len(head_h), dtype=np.int32))  # the more frequent ones come last and stay
        for batch in batches:
            doc_id = batch.column("doc_id")
            for first, last, stream, begin in mixing.streams(texts(batch.column("text"))):
                n = last - first
                start, end = mixing.tokens(stream, begin)
                of = np.searchsorted(begin, start, "right") - 1
                h = mixing.key_hashes(stream, begin, start, end, of).ravel()
                both = np.tile(of, 2)
                number, known = table.find(h)
                number = np.where(known, number, len(head_h))
                sums = [np.bincount(both, v[number], n) for v in (head_known, head_base, head_value)]
                rest_of, rest = both[~known], h[~known]
                order = np.lexsort((rest, rest_of))
                rest_of, rest = rest_of[order], rest[order]
                fresh = np.ones(len(rest), bool)
                fresh[1:] = (rest_of[1:] != rest_of[:-1]) | (rest[1:] != rest[:-1])
                at = np.flatnonzero(fresh)
                cut = pa.array(np.searchsorted(rest_of[at], np.arange(n + 1)), pa.int32())
                times = np.diff(at, append=len(rest)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        doc_id.slice(first, n),
                        pa.array(np.bincount(of, end - start, n).astype(np.int64)),
                        pa.array(np.bincount(of[end - start > 1], minlength=n)),
                        pa.array(sums[0].astype(np.int64)),
                        pa.array(sums[1]),
                        pa.array(sums[2]),
                        pa.ListArray.from_arrays(cut, pa.array(rest[at].view(np.int64))),
                        pa.ListArray.from_arrays(cut, pa.array(times)),
                    ],
                    names=["doc_id", "n_bytes", "n_words", "head_known", "head_sum", "head_value", "tail_h", "tail_n"],
                )

    return docs.mapInArrow(tidied(run), "doc_id long, n_bytes long, n_words long, head_known long, head_sum double, head_value double, tail_h array<long>, tail_n array<int>")


def scores(docs: DataFrame) -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte)``, one row per input row."""
    slim = documents(docs)
    out = held_out(F.col("doc_id"), 10, 0)
    counts = materialize(counted(slim.select("text", (~out).alias("train"))), "lm-counts")
    vocabulary = materialize(vocabulary_of(counts), "lm-vocabulary")
    n_docs = counts.where(F.col("kind") == DOCUMENTS).agg(F.sum("n").alias("n")).first().n or 0
    size = vocabulary.agg(F.sum("n").alias("tokens"), F.count("*").alias("words")).first()
    n_tokens, n_types = (size.tokens or 0) + n_docs, size.words + (n_docs > 0)
    full = contexts.counted_chunks(counts)
    mixer = contexts.train_mixer(full)
    table = materialize(with_base(contexts.key_scores(full, mixer), vocabulary), "lm-scores")
    rows = materialize(scored(slim, head_keys(table)).withColumn("row", F.monotonically_increasing_id()), "lm-rows")
    tails = rows.where(F.size("tail_h") > 0).select("row", F.explode(F.arrays_zip("tail_h", "tail_n")).alias("t")).select("row", F.col("t.tail_h").alias("h"), F.col("t.tail_n").alias("times"))
    tails = (
        tails.join(table, "h")
        .groupBy("row")
        .agg(*(F.sum(F.col("times") * F.col(c)).alias(f"tail_{c}") for c in ("known", "base", "value")))
    )
    each = np.log10(n_tokens + 0.1 * (n_types + 1))
    total = F.col("head_value") + F.coalesce("tail_value", F.lit(0.0)) - float(np.log2(mixing.CLASSES))
    return rows.join(tails, "row", "left").select(
        "doc_id",
        out.alias("held_out"),
        (F.col("n_words") + 1).alias("n_tokens"),
        (F.col("head_known") + F.coalesce("tail_known", F.lit(0)) + int(n_docs > 0)).alias("n_known"),
        F.lit(n_tokens).cast("long").alias("train_tokens"),
        (F.col("head_sum") + F.coalesce("tail_base", F.lit(0.0)) + float(np.log10(n_docs + 0.1)) - (F.col("n_words") + 1) * float(each)).alias("base_score"),
        (total * float(np.log10(2))).alias("score"),
        (-total / F.col("n_bytes")).alias("bits_per_byte"),
    )


def query(docs: DataFrame) -> DataFrame:
    return scores(docs)
