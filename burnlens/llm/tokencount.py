"""Token counts of whole texts, huge documents by overlap resynchronisation.

A text of up to ``chunk`` characters is counted by stretches that the library has
encoded before (``bytebpe``) or is one library call.  A longer one is encoded as overlapping chunks with offsets, and neighbours are spliced at a
boundary that is proven to be one of the whole text:

* the pre-tokenizer scans from left to right and what it cuts after a word
  boundary depends only on the text from there on, while BPE works inside words;
* the first chunk starts at the text's start, so its word boundaries are true
  ones, as long as they lie ``margin`` characters before its end (nothing the
  scanner looks ahead for, special strings included, is longer);
* a chunk that starts anywhere may be out of step at first, but from the first
  word boundary that it shares with its left neighbour's true ones it cuts as
  the whole text does.

If the overlap has no shared boundary (one word may be longer than it), the left
chunk is encoded again from its last proven boundary with a doubled overlap,
until one is found or the chunk holds the rest of its neighbour.

Defined cases: a null or empty text has 0 bytes and 0 tokens; special strings
inside texts count as the library's default does; repeated rows are counted
each; a null ``doc_id`` is kept; an empty table gives no rows.
"""

from __future__ import annotations

import os
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame

from burnlens.llm.bytebpe import ByteBpeCounts
from burnlens.llm.common import documents, tidied

VOCABULARY = "byte_bpe_50k.json"
LIMIT = 512
#: Characters of a chunk, of the overlap at first, and of the library's look-ahead at most.
CHUNK, OVERLAP, MARGIN = 32_768, 256, 32

_open: dict[str, tuple[object, ByteBpeCounts]] = {}


def library(path: str):
    """This process's tokenizer for ``path`` and its table of counts."""
    if path not in _open:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        _open[path] = (tokenizer, ByteBpeCounts(tokenizer))
    return _open[path]


class _Chunk:
    """Ids of ``text[start:end]`` and the positions at which its words begin."""

    def __init__(self, encoding, start: int, end: int) -> None:
        self.ids, self.start, self.end = encoding.ids, start, end
        words = np.array([-1 if w is None else w for w in encoding.word_ids], np.int64)
        first = np.flatnonzero(np.concatenate([[True], words[1:] != words[:-1]])) if len(words) else np.zeros(0, np.int64)
        offsets = encoding.offsets
        self.at = [start + offsets[k][0] for k in first.tolist()]  # where words begin ...
        self.token = first.tolist()  # ... and their first token

    def tokens_before(self, position: int) -> int:
        k = bisect_left(self.at, position)
        return self.token[k] if k < len(self.at) else len(self.ids)

    def shared(self, other: _Chunk, till: int) -> int | None:
        """The first word boundary of both in ``[other.start, till]``."""
        mine = self.at[bisect_left(self.at, other.start) : bisect_left(self.at, till + 1)]
        theirs = set(other.at[: bisect_left(other.at, till + 1)])
        return next((p for p in mine if p in theirs), None)


def spliced(text: str, tokenizer, chunk: int = CHUNK, overlap: int = OVERLAP, margin: int = MARGIN) -> Iterator[list[int]]:
    """The whole text's ids, in stretches."""

    def encode(start: int, end: int) -> _Chunk:
        return _Chunk(tokenizer.encode(text[start:end], add_special_tokens=False), start, end)

    size = len(text)
    if size <= chunk:
        yield tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids
        return
    left, proven, wider = encode(0, min(size, chunk + overlap)), 0, overlap
    while left.end < size:
        start = left.end - overlap
        right = encode(start, min(size, start + max(chunk, wider) + overlap))
        while (p := left.shared(right, left.end - margin)) is None and left.end < right.end:
            wider *= 2
            left = encode(proven, min(right.end, left.end + wider))
        if p is None:  # left has reached right's end
            continue
        yield left.ids[left.tokens_before(proven) : left.tokens_before(p)]
        left, proven, wider = right, p, overlap
    yield left.ids[left.tokens_before(proven) :]


def counts(texts: list[str], tokenizer, table: ByteBpeCounts, chunk: int = CHUNK) -> list[int]:
    short = [k for k, t in enumerate(texts) if len(t) <= chunk]
    known = dict(zip(short, table.counts([texts[k] for k in short])))
    return [n if (n := known.get(k)) is not None else sum(map(len, spliced(t, tokenizer, chunk))) for k, t in enumerate(texts)]


def token_counts(docs: DataFrame, vocabulary: str | None = None, limit: int = LIMIT) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)``, one row per input row."""
    path = vocabulary or public_tokenizers.path(VOCABULARY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, table = library(path)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            n = np.array(counts(texts, tokenizer, table), np.int64)
            size = np.array([len(t) if t.isascii() else len(t.encode()) for t in texts], np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(size), pa.array(n), pa.array(n > limit)], names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return documents(docs).mapInArrow(tidied(run), "doc_id long, n_bytes long, n_tokens long, over_limit boolean")


def query(docs: DataFrame) -> DataFrame:
    return token_counts(docs)
