"""Toxicity by weak supervision.

1. Voters.  A voter fires on a document or not: fixed lexicons, patterns, and
   lexicons mined from labelled rows (whole words and word beginnings that occur
   in toxic documents far more often than in others).
2. Label model.  A generative model of two hidden classes over all documents'
   votes: each voter has its own firing rates (its accuracy), and correlated
   voters depend on each other along a tree that is re-estimated by conditional
   mutual information (Chow-Liu) while EM runs.  It needs no labels and sees every
   document, as counts of vote patterns (2 ** voters at most).
3. Classifier.  A linear classifier over the voters and hashed words and word
   beginnings is trained on the label model's posteriors of a bounded sample and
   calibrated on labelled rows.

Labels are learned only from rows that ``learn`` allows, at most ``SAMPLE_ROWS``
of them (an even sample by hash); votes, rates and correlations are of all rows.

Defined cases: a null or empty text fires no voter and is scored like any other;
label rows that are null, repeated or without a document are harmless (the
largest of repeated ones counts); without labels the fixed voters remain and the
scores are not calibrated; repeated documents give a row each; a null ``doc_id``
is kept and never held out; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from burnlens.llm.common import documents, map_arrow, small_batches, tidied
from burnlens.llm.labelled import SAMPLE_ROWS, held_out, labelled_texts, sampled_labels
from burnlens.llm.wordhash import mixed, prefix_sums, stretch_hash, table_bounds

THRESHOLD = 0.7

# Lexicons by kind, in alphabetical order.
INSULTS = "asshole bastard bitch clown cretin dumbass fool idiot idiots imbecile jackass jerk loser losers moron morons retard scumbag".split()
CONTEMPT = "disgusting garbage pathetic repulsive scum stupid trash vermin vile worthless".split()
PROFANITY = "arse bloody bollocks bullshit crap cunt damn dick fuck fucking piss shit slut whore".split()
THREATS = ["beat you up", "burn in hell", "drop dead", "go to hell", "hope you die", "i will hurt you", "i will kill you", "kill yourself", "shut up", "you deserve to die"]
ATTACKS = ["you are a ", "you are an ", "you are so ", "you re a ", "you're a ", "you're an ", "you're so ", "people like you"]

#: A mined entry occurs in so many toxic sample rows, and so large a share of them, at least, and its odds are this much higher than the sample's.
MINED_ROWS, MINED_SHARE, MINED_ODDS = 4, 0.005, 12.0
#: Mined lexicons: bytes of the word's beginning (0: whole word), and entries of each at most.
MINED = (0, 4, 5, 6)
MINED_ENTRIES = 5000
SHORTEST = 4

INSIDE = np.zeros(256, bool)  # bytes of words: letters, digits and everything beyond ASCII
INSIDE[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

HASH_BITS = 16
ROUNDS, RELINK = 60, 15
EPOCHS, RATE, RIDGE, BATCH = 6, 0.3, 1e-6, 256
#: Bytes of text that are cut into words together.
BYTES_AT_ONCE = 1 << 19


def word_hash(word: str) -> int:
    b = np.frombuffer(word.encode(), np.uint8)
    return int(stretch_hash(prefix_sums(b), np.array([0]), np.array([len(b)]))[0])


def groups(texts: list[str]) -> Iterator[tuple[int, int, list[bytes]]]:
    """Lower-cased texts in bounded groups: ``(first, end, texts)``."""
    held, size, first = [], 0, 0
    for k, t in enumerate(texts):
        held.append(t.lower().encode("utf-8", "replace"))
        size += len(held[-1])
        if size >= BYTES_AT_ONCE:
            yield first, k + 1, held
            held, size, first = [], 0, k + 1
    if held:
        yield first, len(texts), held


def words(texts: list[bytes]) -> tuple[np.ndarray, dict[int, tuple[np.ndarray, np.ndarray]]]:
    """Number of words of each text, and by beginning (0: whole word) the distinct ``(text, hash)`` pairs."""
    joined = b"\n".join(texts)
    buf = np.frombuffer(joined, np.uint8)
    start, end = table_bounds(buf, INSIDE)
    text_start = np.cumsum([0, *(len(t) + 1 for t in texts[:-1])])
    of = np.searchsorted(text_start, start, "right") - 1
    sums = prefix_sums(buf)
    out = {}
    for size in MINED:
        far = end - start >= max(size, SHORTEST)
        a = start[far]
        h = stretch_hash(sums, a, a + size if size else end[far]) + np.uint64(size)
        order = np.lexsort((h, of[far]))
        t, h = of[far][order], h[order]
        fresh = np.ones(len(t), bool)
        fresh[1:] = (t[1:] != t[:-1]) | (h[1:] != h[:-1])
        out[size] = (t[fresh], h[fresh])
    return np.bincount(of, minlength=len(texts)), out


@dataclass
class Voters:
    """Fixed lexicons and patterns, and the mined lexicons by beginning (sorted hashes)."""

    mined: dict[int, np.ndarray]

    names = ("insults", "contempt", "profanity", "threats", "attacks", "shouting", *(f"mined{s or 'words'}" for s in MINED))

    def __post_init__(self) -> None:
        self.fixed = [np.sort(np.array([word_hash(w) for w in lexicon], np.uint64)) for lexicon in (INSULTS, CONTEMPT, PROFANITY)]

    def votes(self, raw: list[str], lowered: list[bytes], found: dict[int, tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """Which voters fire on each text."""
        n = len(raw)
        out = np.zeros((n, len(self.names)), bool)

        def mark(column: int, at: np.ndarray, h: np.ndarray, lexicon: np.ndarray) -> None:
            if len(lexicon) and len(h):
                k = np.minimum(np.searchsorted(lexicon, h), len(lexicon) - 1)
                out[at[lexicon[k] == h], column] = True

        for column, lexicon in enumerate(self.fixed):
            mark(column, *found[0], lexicon)
        phrases = [[p.encode() for p in kind] for kind in (THREATS, ATTACKS)]
        for k, (text, low) in enumerate(zip(raw, lowered)):
            for column, kind in enumerate(phrases, len(self.fixed)):
                out[k, column] = any(p in low for p in kind)
            out[k, 5] = len(text) >= 20 and text.isupper()
        for column, size in enumerate(MINED, 6):
            mark(column, *found[size], self.mined.get(size, np.zeros(0, np.uint64)))
        return out


def hashed(found: dict[int, tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """``(text, column)`` pairs of hashed words and 4-byte beginnings."""
    rows = [found[s][0] for s in (0, 4)]
    mask = np.uint64((1 << HASH_BITS) - 1)
    columns = [((found[s][1] >> np.uint64(20)) & mask).astype(np.int64) + (k << HASH_BITS) for k, s in enumerate((0, 4))]
    return np.concatenate(rows), np.concatenate(columns)


# --- label model -----------------------------------------------------------------


@dataclass
class LabelModel:
    """``rate[j, y, x]``: how often voter j fires in class y when its parent's vote is x."""

    prior: float
    parent: list[int]
    rate: np.ndarray

    def log_odds(self, votes: np.ndarray) -> np.ndarray:
        out = np.full(len(votes), np.log(self.prior / (1 - self.prior)))
        for j, up in enumerate(self.parent):
            x = votes[:, up].astype(int) if up >= 0 else np.zeros(len(votes), int)
            for y, sign in ((1, 1.0), (0, -1.0)):
                p = self.rate[j, y, x]
                out += sign * np.log(np.where(votes[:, j], p, 1 - p))
        return out

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.log_odds(votes), -30, 30)))


def tree(votes: np.ndarray, weight: np.ndarray, toxic: np.ndarray) -> list[int]:
    """Parents of the voters along the maximum spanning tree of their mutual information given the class."""
    j = votes.shape[1]
    info = np.zeros((j, j))
    for y in (toxic, 1 - toxic):
        w = weight * y
        total = w.sum() + 1e-9
        v = votes.astype(float)
        on = (w @ v) / total
        both = (v * w[:, None]).T @ v / total
        for a, b, p in ((1, 1, both), (1, 0, on[:, None] - both), (0, 1, on[None, :] - both), (0, 0, 1 - on[:, None] - on[None, :] + both)):
            pa = on if a else 1 - on
            pb = on if b else 1 - on
            p = np.maximum(p, 1e-12)
            info += total / weight.sum() * p * np.log(p / np.maximum(np.outer(pa, pb), 1e-12))
    parent, linked = [-1] * j, {0}
    while len(linked) < j:
        a, b = max(((a, b) for a in linked for b in range(j) if b not in linked), key=lambda e: (info[e], -e[0], -e[1]))
        parent[b] = a
        linked.add(b)
    return parent


def fit_label_model(votes: np.ndarray, weight: np.ndarray) -> LabelModel:
    """EM over vote patterns with their counts; the toxic class is the one in which voters fire more."""
    n, total = votes.shape[1], weight.sum()
    toxic = np.clip(votes.mean(1) * 3, 0.02, 0.98)
    model = LabelModel(0.1, [-1] * n, np.full((n, 2, 2), 0.5))
    for step in range(ROUNDS):
        if step % RELINK == RELINK - 1:
            model.parent = tree(votes, weight, toxic)
        model.prior = float(np.clip((weight * toxic).sum() / total, 1e-4, 0.5))
        for j, up in enumerate(model.parent):
            x = votes[:, up] if up >= 0 else np.zeros(len(votes), bool)
            for y, r in ((1, toxic), (0, 1 - toxic)):
                for value in (0, 1):
                    w = weight * r * (x == value)
                    # Smoothed towards what the voter does at large in that class.
                    at_large = ((weight * r) @ votes[:, j] + 0.5) / ((weight * r).sum() + 1)
                    model.rate[j, y, value] = np.clip((w @ votes[:, j] + 5 * at_large) / (w.sum() + 5), 1e-5, 1 - 1e-5)
        toxic = model.posterior(votes)
    return model


# --- linear classifier -------------------------------------------------------------


@dataclass
class Linear:
    bias: float
    voters: np.ndarray
    hashed: np.ndarray
    scale: float = 1.0
    shift: float = 0.0

    def margin(self, votes: np.ndarray, at: np.ndarray, column: np.ndarray) -> np.ndarray:
        n = np.bincount(at, minlength=len(votes))
        more = np.bincount(at, self.hashed[column], len(votes)) / np.sqrt(np.maximum(n, 1))
        return self.scale * (self.bias + votes @ self.voters + more) + self.shift

    def score(self, *x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(*x), -30, 30)))


def fit_linear(votes: np.ndarray, rows: list[np.ndarray], target: np.ndarray) -> Linear:
    """Logistic regression on soft targets by Adagrad; ``rows`` has each document's hashed columns."""
    n, j = votes.shape
    model = Linear(0.0, np.zeros(j), np.zeros(2 << HASH_BITS))
    g_bias, g_voters, g_hashed = 1e-8, np.full(j, 1e-8), np.full(2 << HASH_BITS, 1e-8)
    order = np.random.default_rng(7)
    for _ in range(EPOCHS):
        for part in np.array_split(order.permutation(n), max(1, n // BATCH)):
            column = np.concatenate([rows[k] for k in part]) if len(part) else np.zeros(0, np.int32)
            size = np.array([len(rows[k]) for k in part])
            at = np.repeat(np.arange(len(part)), size)
            error = (model.score(votes[part], at, column) - target[part]) / max(1, len(part))
            g = error.sum()
            g_bias += g * g
            model.bias -= RATE * g / np.sqrt(g_bias)
            g = error @ votes[part] + RIDGE * model.voters
            g_voters += g * g
            model.voters -= RATE * g / np.sqrt(g_voters)
            seen, back = np.unique(column, return_inverse=True)
            g = np.bincount(back, (error / np.sqrt(np.maximum(size, 1)))[at], len(seen)) + RIDGE * model.hashed[seen]
            g_hashed[seen] += g * g
            model.hashed[seen] -= RATE * 0.1 * g / np.sqrt(g_hashed[seen])
    return model


def calibrate(model: Linear, margin: np.ndarray, label: np.ndarray) -> None:
    """Scale and shift of the margin that fit labelled rows best (Newton steps, lightly held to 1 and 0)."""
    if len(np.unique(label)) < 2:
        return
    x = np.stack([margin, np.ones_like(margin)], 1)
    prior = np.array([1.0, 0.0])

    def loss(w: np.ndarray) -> float:
        return float(np.logaddexp(0, np.where(label > 0, -1, 1) * (x @ w)).sum() + 0.5 * ((w - prior) ** 2).sum())

    w = prior
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (p - label) + (w - prior)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.eye(2), g)
        while loss(w - step) > loss(w) and np.abs(step).max() > 1e-9:
            step = step / 2
        w = w - step
    if w[0] > 0:
        model.scale, model.shift = float(w[0]), float(w[1])


# --- Spark -------------------------------------------------------------------------


def sketch(lowered: list[bytes]) -> np.ndarray:
    """Smallest hash of three words in a row of each text (of all its words, if there are fewer):
    copies and near copies mostly share it, and no other text has a say in it."""
    joined = b"\n".join(lowered)
    buf = np.frombuffer(joined, np.uint8)
    start, end = table_bounds(buf, INSIDE)
    text_start = np.cumsum([0, *(len(t) + 1 for t in lowered[:-1])])
    of = np.searchsorted(text_start, start, "right") - 1
    h = stretch_hash(prefix_sums(buf), start, end)
    out = np.full(len(lowered), np.iinfo(np.uint64).max, np.uint64)
    if len(h) > 2:
        three = mixed(h[:-2] * np.uint64(3) + h[1:-1] * np.uint64(5) + h[2:] * np.uint64(7))
        whole = of[:-2] == of[2:]
        np.minimum.at(out, of[:-2][whole], three[whole])
    words = np.bincount(of, minlength=len(lowered))
    few = np.flatnonzero((words == 1) | (words == 2))
    first = (np.cumsum(words) - words)[few]
    second = np.where(words[few] == 2, h[np.minimum(first + 1, len(h) - 1)], np.uint64(0)) if len(few) else h[:0]
    out[few] = mixed(h[first] * np.uint64(3) + second * np.uint64(5))
    return out


def mine(labelled: DataFrame) -> dict[int, np.ndarray]:
    """Mined lexicons: words and beginnings with high odds in toxic rows.

    Rows that share their sketch count once, or a group of copies would make
    every rare word in it a sign of its label.
    """

    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, low in groups(batch.column("text").to_pylist()):
                part = batch.slice(first, end - first)
                yield pa.RecordBatch.from_arrays([part.column("text"), part.column("label"), pa.array(sketch(low).view(np.int64))], names=["text", "label", "sketch"])

    labelled = labelled.select("text", "label").mapInArrow(tidied(sketched), "text string, label int, sketch long").groupBy("sketch", "label").agg(F.min("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label = batch.column("label").to_numpy()
            for first, end, low in groups(batch.column("text").to_pylist()):
                _, found = words(low)
                for size, (at, h) in found.items():
                    y = label[first:end][at] > 0
                    seen, back = np.unique(h, return_inverse=True)
                    toxic = np.bincount(back, y, len(seen)).astype(np.int64)
                    every = np.bincount(back, minlength=len(seen))
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(seen), size, np.int32)), pa.array(seen.view(np.int64)), pa.array(toxic), pa.array(every - toxic)], names=["size", "h", "toxic", "other"])

    labelled = labelled.persist()
    rows = labelled.agg(F.count("*").alias("n"), F.sum((F.col("label") > 0).cast("int")).alias("t")).first()
    toxic, other = rows.t or 0, rows.n - (rows.t or 0)
    counts = labelled.mapInArrow(tidied(run), "size int, h long, toxic long, other long").groupBy("size", "h").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
    odds = (F.col("toxic") / (F.col("other") + 0.5)) / ((toxic + 1) / (other + 1))
    out = {}
    strong = counts.where((F.col("toxic") >= max(MINED_ROWS, MINED_SHARE * toxic)) & (odds >= MINED_ODDS)).persist()
    try:
        for size in MINED:
            best = strong.where(F.col("size") == size).orderBy(F.desc("toxic"), "other", "h").limit(MINED_ENTRIES).select("h").collect()
            out[size] = np.sort(np.array([r.h for r in best], np.int64).view(np.uint64))
    finally:
        strong.unpersist()
        labelled.unpersist()
    return out


def vote_patterns(docs: DataFrame, voters: Voters) -> tuple[np.ndarray, np.ndarray]:
    """Distinct vote patterns of all documents, and how many documents have each."""
    bits = 1 << np.arange(len(voters.names))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << len(bits), np.int64)
        for batch in batches:
            raw = batch.column("text").to_pylist()
            for first, end, low in groups(raw):
                votes = voters.votes(raw[first:end], low, words(low)[1])
                total += np.bincount(votes @ bits, minlength=len(total))
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["votes", "n"])

    rows = documents(docs).select("text").mapInArrow(tidied(run), "votes long, n long").groupBy("votes").agg(F.sum("n").alias("n")).orderBy("votes").collect()
    pattern = np.array([r.votes for r in rows], np.int64)
    return (pattern[:, None] & bits) > 0, np.array([r.n for r in rows], np.float64)


@dataclass
class Model:
    voters: Voters
    labels: LabelModel
    linear: Linear

    def scores(self, raw: list[str]) -> np.ndarray:
        out = np.zeros(len(raw))
        for first, end, low in groups(raw):
            found = words(low)[1]
            votes = self.voters.votes(raw[first:end], low, found)
            out[first:end] = self.linear.score(votes.astype(float), *hashed(found))
        return out


def train(docs: DataFrame, labels: DataFrame, learn: Column, label_col: str = "toxic", sample_rows: int = SAMPLE_ROWS) -> Model:
    """The whole model; ``learn`` says which label rows may be learned from."""
    labelled = labelled_texts(docs, sampled_labels(labels, learn, label_col, sample_rows)).persist()
    try:
        voters = Voters(mine(labelled.select("text", "label")))
        patterns, weight = vote_patterns(docs, voters)
        if not len(weight):
            patterns, weight = np.zeros((1, len(voters.names)), bool), np.ones(1)
        model = fit_label_model(patterns, weight)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                raw, label = batch.column("text").to_pylist(), batch.column("label").to_pylist()
                for first, end, low in groups(raw):
                    found = words(low)[1]
                    votes = voters.votes(raw[first:end], low, found)
                    at, column = hashed(found)
                    order = np.argsort(at, kind="stable")
                    rows = np.split(column[order].astype(np.int32), np.searchsorted(at[order], np.arange(1, end - first)))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(label[first:end], pa.int32()), pa.array((votes @ (1 << np.arange(votes.shape[1]))).astype(np.int64)), pa.array([r.tobytes() for r in rows], pa.binary())],
                        names=["label", "votes", "columns"],
                    )

        # A bounded sample: SAMPLE_ROWS rows of hashed columns.
        rows = labelled.select("text", "label").mapInArrow(tidied(run), "label int, votes long, columns binary").orderBy("votes", "columns").collect()
    finally:
        labelled.unpersist()
    bits = 1 << np.arange(len(voters.names))
    votes = (np.array([r.votes for r in rows], np.int64)[:, None] & bits) > 0
    label = (np.array([r.label for r in rows]) > 0).astype(float)
    columns = [np.frombuffer(r.columns, np.int32) for r in rows]
    del rows
    if columns:
        linear = fit_linear(votes.astype(float), columns, model.posterior(votes))
        margin = []
        for k in range(0, len(columns), BATCH):
            part = columns[k : k + BATCH]
            margin.append(linear.margin(votes[k : k + BATCH].astype(float), np.repeat(np.arange(len(part)), [len(c) for c in part]), np.concatenate(part)))
        calibrate(linear, np.concatenate(margin), label)
    else:  # no labelled rows: the label model's own evidence, voter by voter
        some = np.eye(len(bits), dtype=bool)
        none = float(model.log_odds(np.zeros((1, len(bits)), bool))[0])
        linear = Linear(none, model.log_odds(some) - none, np.zeros(2 << HASH_BITS))
    return Model(voters, model, linear)


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``(doc_id, score, predicted)``, one row per input row."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        p = model.scores(batch.column("text").to_pylist())
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(p), pa.array((p >= threshold).astype(np.int32))], names=["doc_id", "score", "predicted"])

    return map_arrow(documents(docs), run, "doc_id long, score double, predicted int")


def drop_toxic(docs: DataFrame, model: Model, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that aren't predicted toxic."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                texts = [t or "" for t in batch.column(batch.schema.get_field_index(text_col)).to_pylist()]
                yield batch.filter(pa.array(model.scores(texts) < threshold))

    small_batches(docs.sparkSession)
    return docs.mapInArrow(tidied(run), docs.schema)


def not_held_out() -> Column:
    return ~held_out(F.col("doc_id").cast("long"), 3, 1)


def query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    model = train(docs, labels, not_held_out())
    return score(docs, model).select("doc_id", held_out(F.col("doc_id"), 3, 1).alias("held_out"), "score", "predicted")
