"""Token counts under a byte-level BPE vocabulary, one library call per new stretch.

The pre-tokenizer never joins a word with more of the white space before it than
one space, and what it cuts in a stretch without white space depends on that
space and the stretch alone.  So a text's count is the sum over its stretches
(with the space before, if there is one) and over the white space that is left,
cut as the pre-tokenizer does: a run before a stretch gives its last character to
the stretch (a space) or keeps it as a word of its own, the rest is one word; a
run that ends the text is one word.  Each worker process keeps a bounded table
``hash -> count`` that the tokenizer library fills.

Texts outside the character range in which this is proven equal to the library
(tests compare every character of it), or with something that looks like a
special token, are for the library.
"""

from __future__ import annotations

import re

import numpy as np

from burnlens.llm.wordhash import HashTable, prefix_sums, stretch_hash, word_bounds

#: Wider white space and characters past this range go to the library.
BEYOND = re.compile("[\x85\xa0]|[^\x00-ſ]")
TABLE_BITS = 21
#: Stretches over this many bytes are never kept.
STRETCH_BYTES = 64
#: Bytes of text that are looked up together.
BYTES_AT_ONCE = 1 << 18


class ByteBpeCounts:
    def __init__(self, library) -> None:
        self.library = library
        vocabulary = library.get_vocab(with_added_tokens=True)
        self.opens = np.zeros(max(vocabulary.values()) + 1, bool)  # tokens that begin with a space
        for piece, i in vocabulary.items():
            self.opens[i] = piece.startswith("Ġ")
        self.table = HashTable(TABLE_BITS)

    def _learn(self, pieces: list[bytes]) -> np.ndarray:
        out = np.zeros(len(pieces), np.int64)
        spaced = [k for k, p in enumerate(pieces) if p[0] == 0x20 and len(p) > 1 and p[1] > 0x20]
        plain = sorted(set(range(len(pieces))) - set(spaced))
        if spaced:
            # As one text: each begins with a space, and with the only token that does.
            ids = np.array(self.library.encode_batch_fast([b"".join([pieces[k] for k in spaced]).decode()], add_special_tokens=False)[0].ids)
            first = np.flatnonzero(self.opens[ids])
            out[spaced] = np.diff(first, append=len(ids))
        if plain:
            out[plain] = [len(e) for e in self.library.encode_batch_fast([pieces[k].decode() for k in plain], add_special_tokens=False)]
        return out

    def _many(self, texts: list[bytes]) -> np.ndarray:
        joined = b"\n".join([*texts, b""])
        buf = np.frombuffer(joined, np.uint8)
        size = np.array([len(t) for t in texts], np.int64)
        text_end = np.cumsum(size + 1) - 1
        text_start = text_end - size
        start, end = word_bounds(buf)
        text = np.searchsorted(text_start, start, "right") - 1
        before = np.maximum(np.concatenate([[0], end[:-1]]), text_start[text]) if len(start) else start
        gap = start - before
        spaced = (gap > 0) & (buf[start - 1] == 0x20)
        rest, alone = gap > 1, (gap > 0) & ~spaced
        last = text_start.copy()
        np.maximum.at(last, text, end)
        tail = last < text_end
        a = np.concatenate([start - spaced, before[rest], start[alone] - 1, last[tail]])
        b = np.concatenate([end, start[rest] - 1, start[alone], text_end[tail]])
        of = np.concatenate([text, text[rest], text[alone], np.flatnonzero(tail)])
        h = stretch_hash(prefix_sums(buf), a, b)
        count, known = self.table.find(h)
        known &= b - a <= STRETCH_BYTES
        if not known.all():
            new, at, back = np.unique(h[~known], return_index=True, return_inverse=True)
            rows = np.flatnonzero(~known)[at]
            found = self._learn([joined[x:y] for x, y in zip(a[rows].tolist(), b[rows].tolist())])
            keep = (b - a)[rows] <= STRETCH_BYTES
            self.table.put(new[keep], found[keep])
            count = count.copy()
            count[~known] = found[back]
        return np.bincount(of, count, len(texts)).astype(np.int64)

    def counts(self, texts: list[str]) -> list[int | None]:
        """Tokens of each text; None for texts that are for the library."""
        out: list[int | None] = [None] * len(texts)
        held: list[bytes] = []
        rows: list[int] = []
        size = 0
        for k, text in enumerate(texts):
            if "<|" in text or not text.isascii() and BEYOND.search(text):
                continue
            held.append(text.encode())
            rows.append(k)
            size += len(held[-1])
            if size >= BYTES_AT_ONCE or k == len(texts) - 1:
                for r, n in zip(rows, self._many(held).tolist()):
                    out[r] = n
                held, rows, size = [], [], 0
        if held:
            for r, n in zip(rows, self._many(held).tolist()):
                out[r] = n
        return out
