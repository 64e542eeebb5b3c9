"""Quality scores by histogram gradient-boosted trees over document statistics.

Every text becomes ``FEATURES`` statistics of its characters, words and lines.
The trees are fitted on a bounded, even sample of labelled rows: statistics are
put into bins by quantiles, each level of a tree is grown from histograms of
gradients, and the finished trees are flat arrays (feature, threshold and leaf by
node number), so all rows of a batch walk a tree together in numpy.

Defined cases: a null or empty text has all statistics 0 and is scored like any
other; label rows that are null, repeated or without a document are harmless (the
largest of repeated ones counts); without labels every score is 0.5; repeated
documents give a row each; a null ``doc_id`` is kept and never held out; an empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from burnlens.llm.common import documents, map_arrow, texts, tidied
from burnlens.llm.labelled import SAMPLE_ROWS, held_out, labelled_texts, sampled_labels
from burnlens.llm.wordhash import mixed, prefix_sums, stretch_hash, table_bounds, word_bounds

THRESHOLD = 0.3
BINS, TREES, DEPTH, RATE, LEAST, RIDGE = 64, 80, 4, 0.2, 10.0, 1.0
#: Bytes of text whose statistics are taken together.
BYTES_AT_ONCE = 1 << 19

FEATURES = (
    "log_bytes",
    "log_words",
    "log_lines",
    "upper",
    "lower",
    "digit",
    "stop_mark",
    "other_mark",
    "white",
    "beyond_ascii",
    "word_bytes",
    "word_bytes_spread",
    "longest_word",
    "words_marked",
    "words_upper",
    "words_with_digit",
    "distinct_words",
    "top_word",
    "word_repeats_last",
    "distinct_pairs",
    "top_pair",
    "distinct_lines",
    "top_line",
    "line_bytes",
    "char_entropy",
)

KIND = np.zeros(256, np.uint8)  # 0 other marks, then:
UPPER, LOWER, DIGIT, STOP, WHITE, BEYOND = range(1, 7)
KIND[0x41:0x5B] = UPPER
KIND[0x61:0x7B] = LOWER
KIND[0x30:0x3A] = DIGIT
KIND[[ord(c) for c in ".,;:'\"()-"]] = STOP
KIND[[0x20, *range(0x09, 0x0E)]] = WHITE
KIND[0x80:] = BEYOND
LINE = np.ones(256, bool)
LINE[[0x0A, 0x0D]] = False


def _repetition(at: np.ndarray, h: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Share of distinct values among each text's values, and of its most frequent one."""
    total = np.maximum(np.bincount(at, minlength=n), 1)
    order = np.lexsort((h, at))
    at, h = at[order], h[order]
    first = np.ones(len(at), bool)
    first[1:] = (at[1:] != at[:-1]) | (h[1:] != h[:-1])
    where = np.flatnonzero(first)
    size = np.diff(where, append=len(at))
    top = np.zeros(n)
    np.maximum.at(top, at[where], size)
    return np.bincount(at[where], minlength=n) / total, top / total


def _group(texts_: list[bytes]) -> np.ndarray:
    n = len(texts_)
    joined = b"\n".join(texts_)
    buf = np.frombuffer(joined, np.uint8)
    size = np.array([len(t) for t in texts_])
    start_of = np.cumsum([0, *(size[:-1] + 1)])
    text_of = lambda starts: np.searchsorted(start_of, starts, "right") - 1
    many = np.maximum(size, 1)
    out = np.zeros((len(FEATURES), n))
    kind = KIND[buf]
    whose = np.repeat(np.arange(n), size + 1)[: len(buf)]
    own = np.ones(len(buf), bool)
    own[(start_of[1:] - 1)] = False  # the separators
    kinds = np.bincount((whose.astype(np.int64) * 8 + kind)[own], minlength=8 * n).reshape(n, 8)
    sums = prefix_sums(buf)
    start, end = word_bounds(buf)
    of = text_of(start)
    words = np.bincount(of, minlength=n)
    count = np.maximum(words, 1)
    length = end - start
    line_start, line_end = table_bounds(buf, LINE)
    line_of = text_of(line_start)
    lines = np.bincount(line_of, minlength=n)
    out[0], out[1], out[2] = np.log1p(size), np.log1p(words), np.log1p(lines)
    for row, k in ((3, UPPER), (4, LOWER), (5, DIGIT), (6, STOP), (7, 0), (8, WHITE), (9, BEYOND)):
        out[row] = kinds[:, k] / many
    out[10] = np.bincount(of, length, n) / count
    out[11] = np.sqrt(np.maximum(np.bincount(of, length.astype(float) ** 2, n) / count - out[10] ** 2, 0))
    np.maximum.at(out[12], of, length)
    out[12] = np.log1p(out[12])
    running = np.zeros((4, len(buf) + 1), np.int64)
    for row, k in enumerate((0, UPPER, LOWER, DIGIT)):
        np.cumsum(kind == k, out=running[row, 1:])
    inside = running[:, end] - running[:, start]
    out[13] = np.bincount(of, inside[0] > 0, n) / count
    out[14] = np.bincount(of, (inside[1] > 1) & (inside[2] == 0), n) / count
    out[15] = np.bincount(of, inside[3] > 0, n) / count
    h = stretch_hash(sums, start, end)
    out[16], out[17] = _repetition(of, h, n)
    same = of[1:] == of[:-1]
    out[18] = np.bincount(of[1:][same], (h[1:] == h[:-1])[same], n) / count
    out[19], out[20] = _repetition(of[1:][same], mixed(h[1:] * np.uint64(3) + h[:-1])[same], n)
    out[21], out[22] = _repetition(line_of, stretch_hash(sums, line_start, line_end), n)
    out[23] = np.log1p(np.bincount(line_of, line_end - line_start, n) / np.maximum(lines, 1))
    for k, (a, z) in enumerate(zip(start_of, start_of + size)):
        p = np.bincount(buf[a:z], minlength=1) / many[k]
        p = p[p > 0]
        out[24, k] = -(p * np.log2(p)).sum()
    return out.T


def statistics(texts_: list[bytes]) -> np.ndarray:
    """One row of ``FEATURES`` per text."""
    parts, held, size = [], [], 0
    for t in texts_:
        held.append(t)
        size += len(t)
        if size >= BYTES_AT_ONCE:
            parts.append(_group(held))
            held, size = [], 0
    if held:
        parts.append(_group(held))
    return np.concatenate(parts) if parts else np.zeros((0, len(FEATURES)))


@dataclass
class Forest:
    """Trees as arrays over node numbers; node k's children are 2 k + 1 (at most the threshold) and 2 k + 2."""

    base: float
    feature: np.ndarray  # trees x inner nodes
    threshold: np.ndarray
    leaf: np.ndarray  # trees x leaves

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        inner = self.feature.shape[1]
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf):
            node = np.zeros(len(x), np.int64)
            while inner and node[0] < inner:
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            out += leaf[node - inner]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -30, 30))) if len(x) else np.zeros(0)


def fit(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> Forest:
    """Newton boosting of the logistic loss with histograms of ``BINS`` quantile bins."""
    n, width = x.shape
    inner = (1 << depth) - 1
    feature, threshold, leaf = np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, inner + 1))
    if not n:
        return Forest(0.0, feature[:0], threshold[:0], leaf[:0])
    mean = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    base = float(np.log(mean / (1 - mean)))
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(width)]
    binned = np.stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(edges)], 1)
    margin = np.full(n, base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            first, size = (1 << level) - 1, 1 << level
            at = node - first
            gain_best = np.full(size, 1e-6)
            split = np.zeros((size, 2), np.int64)
            for f in range(width):
                key = at * BINS + binned[:, f]
                gs = np.bincount(key, g, size * BINS).reshape(size, BINS).cumsum(1)
                hs = np.bincount(key, h, size * BINS).reshape(size, BINS).cumsum(1)
                ga, ha = gs[:, -1:], hs[:, -1:]
                value = lambda a, b: a * a / (b + RIDGE)
                gain = value(gs, hs) + value(ga - gs, ha - hs) - value(ga, ha)
                c = np.bincount(key, minlength=size * BINS).reshape(size, BINS).cumsum(1)
                gain[(c < LEAST) | (c[:, -1:] - c < LEAST)] = 0
                gain[:, len(edges[f]) :] = 0
                best = gain.argmax(1)
                better = gain[np.arange(size), best] > gain_best
                gain_best[better] = gain[np.arange(size), best][better]
                split[better] = np.stack([np.full(size, f), best], 1)[better]
            real = gain_best > 1e-6
            for k in np.flatnonzero(real):
                f, b = split[k]
                feature[t, first + k], threshold[t, first + k] = f, edges[f][b]
            go = x[np.arange(n), feature[t, node]] > threshold[t, node]
            node = 2 * node + 1 + go
        at = node - inner
        leaf[t] = -RATE * np.bincount(at, g, inner + 1) / (np.bincount(at, h, inner + 1) + RIDGE)
        margin += leaf[t, at]
    return Forest(base, feature, threshold, leaf)


def train(docs: DataFrame, labels: DataFrame, learn: Column, label_col: str = "quality", sample_rows: int = SAMPLE_ROWS) -> Forest:
    """Trees from at most about ``sample_rows`` of the label rows that ``learn`` allows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = statistics(texts(batch.column("text")))
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(x.tolist(), pa.list_(pa.float64()))], names=["label", "x"])

    sample = labelled_texts(docs, sampled_labels(labels, learn, label_col, sample_rows))
    rows = sample.select("text", "label").mapInArrow(tidied(run), "label int, x array<double>").orderBy("x", "label").collect()
    x = np.array([r.x for r in rows]).reshape(len(rows), len(FEATURES))
    return fit(x, np.array([r.label > 0 for r in rows], float))


def score(docs: DataFrame, model: Forest, threshold: float = THRESHOLD) -> DataFrame:
    """``(doc_id, score, predicted)``, one row per input row."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        p = model.score(statistics(texts(batch.column("text"))))
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(p), pa.array((p >= threshold).astype(np.int32))], names=["doc_id", "score", "predicted"])

    return map_arrow(documents(docs), run, "doc_id long, score double, predicted int")


def query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    model = train(docs, labels, ~held_out(F.col("doc_id").cast("long"), 5, 0))
    return score(docs, model).select("doc_id", held_out(F.col("doc_id"), 5, 0).alias("held_out"), "score", "predicted")
