"""Bits per byte by logistic mixing of hashed-context bit predictors.

The text is a stream of bytes (A-Z in lower case) with an end byte.  Each bit of
the next byte is predicted in six hashed contexts: the last one to five bytes,
which inside a word reach back to its beginning, and the word so far.  (The first
byte of a word sees the bytes before it, across the border.)  A context counts how
often the bit was 0 and 1 there.  The predictions are mixed in the logistic domain
with weights that a gate selects (bit number, how many contexts are known, whether
the word is).  The weights are learned online, step by step, and a last stage refines
the mix adaptively by what really followed such mixes.

Two contexts also know the text's *class*: which letter beyond ASCII is the most
frequent, if any is, and whether marks are.  The class is told before the text, at
a flat price.

So a text's probability is a product over its *tokens* (words with the byte that
ends them): of the first byte after the five bytes before it, and of the rest
given the first.  Counting and scoring work on distinct tokens and borders with
their numbers.

The contexts' counts are gathered exactly over Spark (``contexts``).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import zstandard

from burnlens.llm.wordhash import LOWER, SPACE, HashTable, mixed, prefix_sums, stretch_hash

#: Contexts: 1 to 5 bytes, word.
ORDERS = 6
#: Counts before anything is seen.
PRIOR = 0.15
GATES = 8 * (ORDERS) * 2
LEVELS, LEVEL_STEP = 33, 0.5
START, END = b"\n" * 5, b"\0"
#: What stands before a word for contexts that reach back past its beginning.
BEFORE = 0x20
#: Classes of texts, the contexts that know them, and the least shares of letters beyond ASCII and of marks that count.
CLASSES, CLASS_ORDERS, LETTER_SHARE, MARK_SHARE = 32, (3, 5), 0.002, 0.05
#: Distinct borders and tokens that a task holds before it passes them on.
HELD = 1_000_000
TALLY_BITS = 20
#: Distinct events of an online step, the pull to the first weights, and how far one step may move a weight.
STEP_EVENTS, PULL, STEP_LIMIT = 1 << 13, 1.0, 0.25
#: Bytes of text and events that are worked on together.
BYTES_AT_ONCE, EVENTS_AT_ONCE = 1 << 18, 1 << 15

_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


def streams(texts: list[bytes]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first, end, stream, first byte of each text)`` for bounded groups of texts.

    Each text stands between five line ends, which are only context, and its end byte.
    """
    first, held, size = 0, [], 0
    for k in range(len(texts) + 1):
        if held and (k == len(texts) or size >= BYTES_AT_ONCE):
            stream = LOWER[np.frombuffer(b"".join([START + t + END for t in held]), np.uint8)]
            whole = np.array([len(t) + len(START) + len(END) for t in held])
            yield first, k, stream, np.cumsum(whole) - whole + len(START)
            first, held, size = k, [], 0
        if k < len(texts):
            held.append(texts[k])
            size += len(texts[k])


def tokens(stream: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the tokens of all texts, each with the byte that ends it."""
    ends = SPACE[stream]
    ends[begin[1:] - len(START) - 1] = True
    ends[-1] = True
    for k in range(1, len(START) + 1):
        ends[begin - k] = False
    end = np.flatnonzero(ends)
    start = np.concatenate([[0], end[:-1] + 1])
    first = np.searchsorted(end, begin)  # the token that each text begins with
    start[first] = begin
    return start, end + 1


def classes(stream: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Class of each text."""
    n = len(begin)
    last = np.append(begin[1:] - len(START), len(stream))
    of = np.repeat(np.arange(n), np.diff(np.append(begin - len(START), len(stream))))
    seen = np.bincount(of * 256 + stream, minlength=256 * n).reshape(n, 256)
    size = np.maximum(last - begin, 1)
    letter = seen[:, 0x80:0xC0].argmax(1)
    often = seen[np.arange(n), 0x80 + letter] >= LETTER_SHARE * size
    marks = seen[:, [0x21, *range(0x23, 0x27), 0x2A, 0x2B, 0x3C, 0x3D, 0x3E, 0x40, 0x5C, 0x5E, 0x5F, 0x7C, 0x7E]].sum(1) >= MARK_SHARE * size
    return (np.where(often, 1 + letter % 15, 0) * 2 + marks).astype(np.uint64)


def known_class(window: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """Windows that carry their text's class."""
    return window | kind << np.uint64(48)


def windows(buf: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The five bytes before ``at`` and the byte there, which is the lowest."""
    out = buf[at].astype(np.uint64)
    for k in range(1, 6):
        out |= buf[np.maximum(at - k, 0)].astype(np.uint64) << np.uint64(8 * k)
    return out


def anchored(window: np.ndarray, inside: np.ndarray) -> np.ndarray:
    """Windows whose byte is number ``inside`` (1 or more) of its token: nothing before the token shows."""
    shift = (np.minimum(inside, 5) * 8 + 8).astype(np.uint64)
    kept = window & ((np.uint64(1) << shift) - np.uint64(1))
    return np.where(inside < 5, kept | np.uint64(BEFORE) << np.minimum(shift, np.uint64(40)), window)  # without a class


def rests(words: list[bytes], kind: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Events of the tokens' bytes but the first: ``(window, word so far, token)``."""
    buf = np.frombuffer(b"".join(words), np.uint8)
    size = np.array([len(w) for w in words], np.int64)
    start = np.cumsum(size) - size
    of = np.repeat(np.arange(len(words)), size)
    at = np.arange(len(buf))
    inside = at - start[of]
    later = inside > 0
    at, of, inside = at[later], of[later], inside[later]
    return known_class(anchored(windows(buf, at), inside), kind[of]), stretch_hash(prefix_sums(buf), start[of], at), of


def bits(window: np.ndarray) -> np.ndarray:
    return np.unpackbits(window.astype(np.uint8)).view(bool).reshape(-1, 8)


def squash(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -25, 25)))


def gates(inputs: np.ndarray) -> np.ndarray:
    """Gate numbers (events x 8) from the inputs (contexts x events x 8): an input of 0 is unknown."""
    known = (inputs[:-1] != 0).sum(0)
    return (np.arange(8) * ORDERS + known) * 2 + (inputs[-1] != 0)


def levels(mix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower level and how far the mix lies above it."""
    x = np.clip(mix / LEVEL_STEP + LEVELS // 2, 0, LEVELS - 1.001)
    low = x.astype(np.int64)
    return low, x - low


@dataclass
class Mixer:
    weights: np.ndarray  # gates x contexts
    hits: np.ndarray  # bits x levels: weight of what followed, and of ones
    ones: np.ndarray

    @classmethod
    def fresh(cls) -> Mixer:
        level = squash((np.arange(LEVELS) - LEVELS // 2) * LEVEL_STEP)
        return cls(np.full((GATES, ORDERS), 0.3), np.full((8, LEVELS), 20.0), np.tile(20 * level, (8, 1)))

    def mix(self, inputs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        gate = gates(inputs)
        out = np.zeros(inputs.shape[1:])
        for k in range(ORDERS):
            out += self.weights[gate, k] * inputs[k]
        return gate, out

    def refined(self, mix: np.ndarray) -> np.ndarray:
        """Probability of a one: the mix and what followed such mixes, half and half."""
        rate = self.ones / self.hits
        low, far = levels(mix)
        bit = np.arange(8)
        return (squash(mix) + rate[bit, low] * (1 - far) + rate[bit, low + 1] * far) / 2


class Learner:
    """A mixer that learns online from one stretch of events.

    A step predicts some events with the weights so far, adds their curvature to what
    each gate has seen, and moves the gate's weights by its share of their error: what
    came before weighs as much as it held.  The same predictions fill the table that
    refines them.  ``summary`` is what stretches that were learned apart add up.
    """

    def __init__(self) -> None:
        self.mixer = Mixer.fresh()
        self.curve = np.tile(PULL * np.eye(ORDERS), (GATES, 1, 1))

    def step(self, inputs: np.ndarray, bit: np.ndarray, number: np.ndarray) -> None:
        """``inputs`` (contexts x events x 8) of events that occur ``number`` times."""
        gate, mix = self.mixer.mix(inputs)
        low, far = levels(mix)
        times = np.repeat(number, 8)
        cell = (np.arange(8) * LEVELS + low).ravel()
        ones = times * bit.ravel()
        for at, share in ((cell, 1 - far.ravel()), (cell + 1, far.ravel())):
            self.mixer.hits += np.bincount(at, share * times, 8 * LEVELS).reshape(8, LEVELS)
            self.mixer.ones += np.bincount(at, share * ones, 8 * LEVELS).reshape(8, LEVELS)
        flat = gate.ravel().astype(np.uint8)  # short numbers are sorted by counting
        order = np.argsort(flat, kind="stable")
        flat = flat[order]
        first = np.flatnonzero(np.diff(flat, prepend=np.uint8(GATES)))
        gates_here = flat[first]
        p = squash(mix.ravel()[order])
        x = inputs.reshape(ORDERS, -1)[:, order].astype(np.float64)
        error, curve = ones[order] - times[order] * p, times[order] * p * (1 - p)
        for g, a, b in zip(gates_here, first, np.append(first[1:], len(order))):
            part = x[:, a:b]
            self.curve[g] += (part * curve[a:b]) @ part.T
            move = np.linalg.solve(self.curve[g], part @ error[a:b])
            self.mixer.weights[g] += np.clip(move, -STEP_LIMIT, STEP_LIMIT)

    def summary(self) -> np.ndarray:
        fresh = Mixer.fresh()
        pull = PULL * np.eye(ORDERS)
        held = (self.curve @ self.mixer.weights[:, :, None])[:, :, 0] - PULL * fresh.weights
        return np.concatenate([(self.curve - pull).ravel(), held.ravel(), (self.mixer.hits - fresh.hits).ravel(), (self.mixer.ones - fresh.ones).ravel()])

    @staticmethod
    def merged(total: np.ndarray) -> Mixer:
        """The mixer of all stretches: their weights, by what each had seen."""
        out = Mixer.fresh()
        curve, held, hits, ones = np.split(total, np.cumsum([GATES * ORDERS * ORDERS, GATES * ORDERS, 8 * LEVELS]))
        curve = curve.reshape(GATES, ORDERS, ORDERS) + PULL * np.eye(ORDERS)
        out.weights = np.linalg.solve(curve, (held.reshape(GATES, ORDERS) + PULL * out.weights)[:, :, None])[:, :, 0]
        out.hits, out.ones = out.hits + hits.reshape(8, LEVELS), out.ones + ones.reshape(8, LEVELS)
        return out


#: Numbers of a ``Learner.summary``.
SUMMARY = GATES * ORDERS * (ORDERS + 1) + 2 * 8 * LEVELS

CLASS_BYTE = [bytes([c]) for c in range(CLASSES)]
CLASS_OF = {b: c for c, b in enumerate(CLASS_BYTE)}
NOTHING = stretch_hash(prefix_sums(np.zeros(0, np.uint8)), np.zeros(1, np.int64), np.zeros(1, np.int64))


def packed(a: np.ndarray) -> bytes:
    """Compressed numbers, byte by byte of equal rank; first the number of ranks beyond which
    all bytes are 0."""
    most = int(a.max()) if len(a) else 0
    width = a.itemsize if len(a) and a.min() < 0 else max((most.bit_length() + 7) // 8, 1)
    raw = a.view(np.uint8).reshape(len(a), a.itemsize)
    ranks = np.empty((width, len(a)), np.uint8)
    for k in range(width):
        ranks[k] = raw[:, k]
    return bytes([width]) + zstandard.ZstdCompressor(level=1).compress(ranks.tobytes())


def unpacked(b: bytes, dtype: type) -> np.ndarray:
    ranks = np.frombuffer(zstandard.ZstdDecompressor().decompress(b[1:]), np.uint8).reshape(b[0], -1)
    out = np.zeros(ranks.shape[1], dtype)
    raw = out.view(np.uint8).reshape(len(out), out.itemsize)
    for k in range(b[0]):
        raw[:, k] = ranks[k]
    return out


class Tally:
    """Numbers of distinct things by hash; one that lost its place in the table may stand twice."""

    def __init__(self, bits: int) -> None:
        self.table = HashTable(bits)
        self.held = 0
        self.count = np.zeros(1 << 16, np.int64)

    def add(self, h: np.ndarray) -> np.ndarray:
        """Counts the hashes; positions of the first of each new one, in the order of their numbers."""
        number, known = self.table.find(h)
        np.add.at(self.count, number[known], 1)
        unknown = np.flatnonzero(~known)
        new, at, n = np.unique(h[unknown], return_index=True, return_counts=True)
        end = self.held + len(new)
        if end > len(self.count):
            self.count = np.concatenate([self.count, np.zeros(max(end, len(self.count)), np.int64)])
        self.count[self.held : end] = n
        self.table.put(new, np.arange(self.held, end, dtype=np.int32))
        self.held = end
        return unknown[at]

    def counts(self) -> np.ndarray:
        return self.count[: self.held]


TOKEN, BORDER = 0, 1


class Counter:
    """Numbers of the distinct tokens (after their text's class) and borders of many texts, as ``(kind, key)`` rows."""

    def __init__(self) -> None:
        self.clear()

    def clear(self) -> None:
        self.borders, self.tokens = Tally(TALLY_BITS), Tally(TALLY_BITS)
        self.border: list[np.ndarray] = []
        self.token: list[bytes] = []

    def full(self) -> bool:
        return self.borders.held + self.tokens.held > HELD

    def add(self, stream: np.ndarray, begin: np.ndarray) -> None:
        start, end = tokens(stream, begin)
        sums = prefix_sums(stream)
        kind = classes(stream, begin)[np.searchsorted(begin, start, "right") - 1]
        border = known_class(windows(stream, start), kind)
        self.border.append(border[self.borders.add(mixed(border))])
        new = self.tokens.add(stretch_hash(sums, start, end) + kind * _C)
        raw = stream.tobytes()
        self.token += [CLASS_BYTE[c] + raw[a:b] for c, a, b in zip(kind[new].tolist(), start[new].tolist(), end[new].tolist())]

    def rows(self) -> Iterator[tuple[int, list[bytes], np.ndarray]]:
        """``(kind, keys, numbers)``; forgets them."""
        raw = np.concatenate(self.border).tobytes() if self.border else b""
        border = [raw[k : k + 8] for k in range(0, len(raw), 8)]
        yield TOKEN, self.token, self.tokens.counts()
        yield BORDER, border, self.borders.counts()
        self.clear()


def key_hashes(stream: np.ndarray, begin: np.ndarray, start: np.ndarray, end: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Hashes of the tokens and of the borders before them (2 x tokens), with their texts' classes."""
    kind = classes(stream, begin)[of]
    return np.stack([stretch_hash(prefix_sums(stream), start, end) + kind * _C, mixed(known_class(windows(stream, start), kind))])


def word_counts(keys: list[bytes], number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and numbers of the words of tokens (a class byte, the word, the byte that ends it)."""
    buf = np.frombuffer(b"".join(keys), np.uint8)
    size = np.array([len(k) for k in keys], np.int64)
    end = np.cumsum(size) - 1
    real = size > 2
    return stretch_hash(prefix_sums(buf), (end + 2 - size)[real], end[real]), number[real]
