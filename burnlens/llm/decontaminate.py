"""Benchmark decontamination by pigeonhole edit matching.

Texts are compared with A-Z in lower case and every white-space run as one
space.  An item of m characters may differ from a passage in up to
``m // CHARS_PER_ERROR`` edits.  It is cut into one piece more than that, so an
occurrence holds at least one piece unchanged; an Aho-Corasick automaton of all
pieces finds those in one pass over each whole text.

A piece hit is verified up a binary tree over the item's pieces: a node of s
pieces may have s - 1 errors (if both children had as many errors as pieces, the
node would have too many), so a hit climbs from two pieces to the whole item and
stops at the first node that doesn't match.  Each check is Myers' bit-parallel
edit distance, free at both ends of the window that the errors allow.  Items of
one template share their lower nodes: a node of equal text is checked once for
all items around a hit, and once for all windows of equal text.

The items go to the tasks in blocks of a bounded number of characters; further
blocks are further passes, each written before the next.

Defined cases: a null or empty text matches nothing, nor does an item without
words; an item too short for an error must occur unchanged; very long texts are
searched whole; of an item's equally close passages the first that a piece leads
to counts; repeated items and repeated documents give a row each; null ids are
kept; extra columns are left out by ``find`` and kept by ``drop_contaminated``;
an empty table on either side gives no matches.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cached_property

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from burnlens.llm.common import documents, in_steps, materialize, small_batches, tidied

CHARS_PER_ERROR = 10
#: Characters of the items in one block.
BLOCK_CHARS = 400_000
#: Characters of verified windows that a task remembers; then it begins anew.
REMEMBERED = 8_000_000

WORD = re.compile("[^ \t\n\x0b\x0c\r]+")
MATCH = "doc_id long, item_id long, errors int, start int, end int"

Items = list[tuple[int | None, str]]


def normal(text: str) -> str:
    return b" ".join(text.encode().lower().split()).decode()


class Pattern:
    """Myers' bit vectors of one string."""

    def __init__(self, text: str) -> None:
        self.text, self.size = text, len(text)

    @cached_property
    def bits(self) -> dict[str, int]:
        bits: dict[str, int] = {}
        for k, c in enumerate(self.text):
            bits[c] = bits.get(c, 0) | 1 << k
        return bits

    def best(self, window: str) -> tuple[int, int]:
        """Least edits of the pattern against any stretch of ``window``, and where the first such stretch ends."""
        every = (1 << self.size) - 1
        top = 1 << (self.size - 1)
        plus, minus, score = every, 0, self.size
        least, end = score, 0
        bits = self.bits
        for k, c in enumerate(window, 1):
            eq = bits.get(c, 0)
            xv = eq | minus
            xh = (((eq & plus) + plus) ^ plus) | eq
            up = minus | ~(xh | plus) & every
            down = plus & xh
            if up & top:
                score += 1
            elif down & top:
                score -= 1
                if score < least:
                    least, end = score, k
            up = up << 1 & every
            down = down << 1 & every
            plus = down | ~(xv | up) & every
            minus = up & xv
        return least, end


class Step:
    """A node above a piece, shared by all items in which that node has the same
    text, the piece stands at the same place of it, and the node may have as many
    errors.  ``items`` are the items that end here: the node is their whole text."""

    __slots__ = ("above", "after", "before", "errors", "items", "pattern")

    def __init__(self, pattern: Pattern, before: int, after: int, errors: int) -> None:
        self.pattern, self.before, self.after, self.errors = pattern, before, after, errors
        self.above: dict[tuple[str, int, int], Step] = {}
        self.items: list[int] = []


class Matcher:
    """``items`` holds (id, normal text) by item number; items without words are left out."""

    def __init__(self, items: Items, chars_per_error: int) -> None:
        self.automaton = ahocorasick.Automaton()
        self.items: list[tuple[int | None, str]] = []
        self.patterns: dict[str, Pattern] = {}
        self.known: dict[tuple[str, str], int] = {}
        self.remembered = 0
        pieces: dict[str, Step] = {}
        numbers: dict[str, list[int]] = {}
        for item_id, raw in items:
            if text := normal(raw):
                numbers.setdefault(text, []).append(len(self.items))
                self.items.append((item_id, text))
        for text, own in numbers.items():
            errors = len(text) // chars_per_error
            cuts = [k * len(text) // (errors + 1) for k in range(errors + 2)]
            for k in range(errors + 1):
                self.climbs(text, cuts, k, pieces).items += own
        for piece, step in pieces.items():
            self.automaton.add_word(piece, (len(piece), step))
        if pieces:
            self.automaton.make_automaton()
        else:
            self.automaton = None

    def climbs(self, text: str, cuts: list[int], k: int, pieces: dict[str, Step]) -> Step:
        """Lay the path from piece ``k`` up to the whole item, along what other items have laid; its last step."""
        path, lo, hi = [], 0, len(cuts) - 1
        while hi - lo > 1:
            path.append((lo, hi))
            half = (lo + hi) // 2
            lo, hi = (lo, half) if k < half else (half, hi)
        piece = text[cuts[k] : cuts[k + 1]]
        if (step := pieces.get(piece)) is None:
            step = pieces[piece] = Step(self.pattern(piece), 0, len(piece), 0)
        for lo, hi in reversed(path):
            inside, before, errors = text[cuts[lo] : cuts[hi]], cuts[k] - cuts[lo], hi - lo - 1
            key = (inside, before, errors)
            if key not in step.above:
                step.above[key] = Step(self.pattern(inside), before, len(inside) - before, errors)
            step = step.above[key]
        return step

    def pattern(self, text: str) -> Pattern:
        if text not in self.patterns:
            self.patterns[text] = Pattern(text)
        return self.patterns[text]

    def least(self, pattern: Pattern, window: str) -> int:
        """Least edits of the pattern in the window, remembered for windows of equal text."""
        key = (pattern.text, window)
        if (errors := self.known.get(key)) is None:
            self.remembered += len(window)
            if self.remembered > REMEMBERED:
                self.known.clear()
                self.remembered = len(window)
            errors = self.known[key] = pattern.best(window)[0]
        return errors

    def around(self, text: str, at: int, piece: Step) -> dict[int, tuple[int, int]]:
        """By item number, the items that hold within their budgets around the
        piece's hit that begins at ``at``: errors, and where in the item the piece stands."""
        out: dict[int, tuple[int, int]] = {}
        steps = [(piece, 0)]
        while steps:
            step, errors = steps.pop()
            for number in step.items:
                found = (errors, step.before)
                out[number] = min(out.get(number, found), found)
            for above in step.above.values():
                window = text[max(0, at - above.before - above.errors) : at + above.after + above.errors]
                if (errors := self.least(above.pattern, window)) <= above.errors:
                    steps.append((above, errors))
        return out

    def matches(self, raw: str, first_only: bool = False) -> dict[int, tuple[int, int, int]]:
        """By item number: least errors, and start and end of that passage in the normal text."""
        if self.automaton is None or not raw:
            return {}
        text = normal(raw)
        out: dict[int, tuple[int, int, int]] = {}
        for last, (size, piece) in self.automaton.iter(text):
            at = last - size + 1
            placed: dict[str, tuple[int, int, int]] = {}
            for number, (errors, before) in self.around(text, at, piece).items():
                if (known := out.get(number)) and known[0] <= errors:
                    continue
                item = self.items[number][1]
                if item not in placed:
                    placed[item] = self.place(text, at - before, item, errors)
                out[number] = placed[item]
                if first_only:
                    return out
        return out

    def place(self, text: str, at: int, item: str, errors: int) -> tuple[int, int, int]:
        """Errors, start and end of the item's closest passage, which begins about ``at``."""
        lo = max(0, at - errors)
        window = text[lo : min(len(text), at + len(item) + errors)]
        least, end = self.pattern(item).best(window)
        _, back = Pattern(item[::-1]).best(window[:end][::-1])
        return least, lo + end - back, lo + end


def original_span(raw: str, start: int, end: int) -> tuple[int, int]:
    """Where ``[start, end)`` of the normal text stands in ``raw``."""
    at, first, last = 0, None, 0
    for word in WORD.finditer(raw):
        size = word.end() - word.start()
        if first is None and start < at + size + 1:
            first = word.start() + min(max(0, start - at), size)
        if end > at:
            last = word.start() + min(size, end - at)
        if at + size >= end:
            break
        at += size + 1
    return first or 0, last


def blocks(benchmark: DataFrame, block_chars: int = BLOCK_CHARS, id_col: str = "item_id", text_col: str = "text") -> Iterator[Items]:
    """The items, in lists of about ``block_chars`` characters."""
    items = benchmark.select(F.col(id_col).cast("long").alias("item_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    chars = items.agg(F.sum(F.length("text")).alias("n")).first().n or 0
    n = int(chars // block_chars) + 1
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(n))
    for b in range(n):
        if rows := [(r.item_id, r.text) for r in items.where(part == b).sort("item_id", "text").collect()]:
            yield rows


def find(docs: DataFrame, benchmark: DataFrame, chars_per_error: int = CHARS_PER_ERROR, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``(doc_id, item_id, errors, start, end)``: each item that a document holds,
    with its closest passage (characters of the text, end exclusive)."""
    slim = documents(docs)
    names = ["doc_id", "item_id", "errors", "start", "end"]
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32()]

    def one(items: Items) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(items, chars_per_error)
            for batch in batches:
                rows = []
                for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                    raw = text.as_py()
                    for number, (errors, start, end) in sorted(matcher.matches(raw).items()):
                        rows.append((doc_id, matcher.items[number][0], errors, *original_span(raw, start, end)))
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names=names)

        return slim.mapInArrow(tidied(run), MATCH)

    found = in_steps((one(items) for items in blocks(benchmark, block_chars)), "decontaminate-found")
    return one([]) if found is None else found


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, chars_per_error: int = CHARS_PER_ERROR, block_chars: int = BLOCK_CHARS, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose text holds no item."""

    def one(rows: DataFrame, items: Items) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(items, chars_per_error)
            for batch in batches:
                at = batch.schema.get_field_index(text_col)
                keep = [not matcher.matches(t.as_py() or "", first_only=True) for t in batch.column(at)]
                yield batch.filter(pa.array(keep, pa.bool_()))

        return rows.mapInArrow(tidied(run), rows.schema)

    small_batches(docs.sparkSession)
    for k, items in enumerate(blocks(benchmark, block_chars)):
        # Each pass is written before the next: a chain of them would need a worker for each.
        docs = one(materialize(docs, "decontaminate-kept") if k else docs, items)
    return docs


def query(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return find(docs, benchmark)
