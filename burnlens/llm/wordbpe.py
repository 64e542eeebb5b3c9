"""Ids of a lower-casing word-level BPE vocabulary, one library call per new word.

The vocabulary's pre-tokenizer cuts a text into words that the BPE model then
handles one by one, so a text's ids are its words' ids in a row, and those of a
stretch without white space don't depend on what stands around it.  Each worker
process keeps a bounded table ``hash of a stretch -> ids`` that the tokenizer
library fills; texts are cut, looked up and put together in numpy.

Texts outside the character range in which the cut below is proven equal to the
library's (tests compare every character of it), or with something that looks
like a special token, go through the library whole.
"""

from __future__ import annotations

import os
import re
import unicodedata

import numpy as np

from burnlens.llm.wordhash import HashTable, prefix_sums, stretch_hash, word_bounds

#: Characters below this code point have the same classes and lower case here and
#: in the library, but for one capital whose lower case lies beyond.
RANGE_END, EXCEPT = 0x180, "İ"
#: Entries and ids of the table, and bits of its slots.
TABLE_STRETCHES, TABLE_IDS, TABLE_BITS = 800_000, 8_000_000, 21
#: Stretches over this many bytes are never kept.
STRETCH_BYTES = 64
#: Bytes of text that are looked up together.
BYTES_AT_ONCE = 1 << 18


def _class(kinds: str) -> str:
    return "".join(re.escape(chr(c)) for c in range(RANGE_END) if unicodedata.category(chr(c))[0] in kinds)


LETTERS, NUMBERS, SPACES = _class("L"), _class("N"), re.escape("\t\n\x0b\x0c\r \x85\xa0")
CUT = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[{NUMBERS}]|[^{SPACES}{LETTERS}{NUMBERS}]+")
BEYOND = re.compile(f"[^\x00-{chr(RANGE_END - 1)}]|{EXCEPT}")
WIDE_SPACES = re.compile("[\x85\xa0]")

_open: dict[str, WordBpe] = {}


class WordBpe:
    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        vocabulary = self.library.get_vocab(with_added_tokens=True)
        self.closes = np.zeros(max(vocabulary.values()) + 1, bool)
        for piece, i in vocabulary.items():
            self.closes[i] = piece.endswith("</w>")
        self._clear()

    def _clear(self) -> None:
        self.table = HashTable(TABLE_BITS)
        # An entry's ids are store[first : first + count].
        self.first, self.count = np.zeros(1 << 16, np.uint32), np.zeros(1 << 16, np.uint32)
        self.store = np.zeros(1 << 18, np.uint16 if len(self.closes) <= 1 << 16 else np.uint32)
        self.entries = self.stored = 0

    @classmethod
    def of(cls, path: str) -> WordBpe:
        """This process's tokenizer for ``path``."""
        if path not in _open:
            _open[path] = cls(path)
        return _open[path]

    def _encode(self, stretches: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and how many each stretch has.

        Its words go to the library as one text; a word's last id is the only
        one that closes a word.
        """
        words: list[str] = []
        of: list[int] = []
        for b in stretches:
            s = b.decode()
            if s.isalpha():
                words.append(s)
                of.append(1)
            else:
                words += (cut := CUT.findall(s))
                of.append(len(cut))
        ids = np.array(self.library.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, "<u4")
        ends = np.concatenate([[0], np.flatnonzero(self.closes[ids]) + 1])
        return ids, np.diff(ends[np.concatenate([[0], np.cumsum(of)])])

    def _add(self, ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Numbers of new entries."""
        n, m = self.entries + len(counts), self.stored + len(ids)
        for name, size in (("first", n), ("count", n), ("store", m)):
            if size > len(old := getattr(self, name)):
                setattr(self, name, np.concatenate([old, np.zeros(max(len(old), size - len(old)), old.dtype)]))
        self.count[self.entries : n] = counts
        self.first[self.entries : n] = self.stored + np.cumsum(counts) - counts
        self.store[self.stored : m] = ids
        numbers = np.arange(self.entries, n)
        self.entries, self.stored = n, m
        return numbers

    def _many(self, texts: list[bytes]) -> list[bytes]:
        joined = b"\n".join(texts)
        buf = np.frombuffer(joined, np.uint8)
        if self.entries > TABLE_STRETCHES or self.stored > TABLE_IDS:
            self._clear()
        start, end = word_bounds(buf)
        h = stretch_hash(prefix_sums(buf), start, end)
        number, known = self.table.find(h)
        known &= end - start <= STRETCH_BYTES
        if not known.all():
            new, at, back = np.unique(h[~known], return_index=True, return_inverse=True)
            rows = np.flatnonzero(~known)[at]
            ids, counts = self._encode([joined[s:e] for s, e in zip(start[rows].tolist(), end[rows].tolist())])
            added = self._add(ids, counts)
            keep = (end - start)[rows] <= STRETCH_BYTES
            self.table.put(new[keep], added[keep])
            number = number.copy()
            number[~known] = added[back]
        counts = self.count[number].astype(np.int64)
        till = np.cumsum(counts)
        total = int(till[-1]) if len(till) else 0
        ids = self.store[np.repeat(self.first[number] - till + counts, counts) + np.arange(total)].astype("<u4").tobytes()
        text_end = np.cumsum([len(t) + 1 for t in texts])
        cuts = np.concatenate([[0], till])[np.searchsorted(start, text_end)] * 4
        return [ids[a:b] for a, b in zip([0, *cuts[:-1].tolist()], cuts.tolist())]

    def ids(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of whole texts, without added special tokens."""
        out: list[bytes] = [b""] * len(texts)
        held: list[bytes] = []
        rows: list[int] = []
        size = 0
        for k, text in enumerate(texts):
            if not text.isascii():
                text = unicodedata.normalize("NFC", text)
            if "<|" in text or not text.isascii() and BEYOND.search(text):
                out[k] = np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
                continue
            text = text.lower()
            if not text.isascii():
                text = WIDE_SPACES.sub(" ", text)
            held.append(text.encode())
            rows.append(k)
            size += len(held[-1])
            if size >= BYTES_AT_ONCE:
                for r, ids in zip(rows, self._many(held)):
                    out[r] = ids
                held, rows, size = [], [], 0
        if held:
            for r, ids in zip(rows, self._many(held)):
                out[r] = ids
        return out
