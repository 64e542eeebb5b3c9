import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from burnlens.llm import packing, tokencount
from burnlens.llm.wordbpe import RANGE_END, WordBpe

WORD = public_tokenizers.path("word_bpe_49k.json")
BYTE = public_tokenizers.path("byte_bpe_50k.json")


def mixed_texts(n, seed=3):
    rnd = random.Random(seed)
    return ["".join(rnd.choice("abT's're12é ß\n\t .,!¼ \x85\xa0\x1cĲ東İΣ<|>") for _ in range(rnd.randint(0, 60))) for _ in range(n)]


def test_word_ids_equal_the_library():
    bpe, plain = WordBpe.of(WORD), Tokenizer.from_file(WORD)
    texts = mixed_texts(2000) + ["<|startoftext|>a<|endoftext|>", "a" * 500, ""]
    for c in map(chr, range(RANGE_END)):
        texts += [c, f"a{c}b", f"{c * 3}!", f"1{c}'s", f"'{c}", f" {c} "]
    want = [np.array(plain.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert bpe.ids(texts) == want
    assert bpe.ids(texts[::-1]) == want[::-1]


def test_word_ids_when_the_table_is_full(monkeypatch):
    from burnlens.llm import wordbpe

    monkeypatch.setattr(wordbpe, "TABLE_STRETCHES", 20)
    monkeypatch.setattr(wordbpe, "TABLE_BITS", 4)
    monkeypatch.setattr(wordbpe, "BYTES_AT_ONCE", 100)
    plain, texts = Tokenizer.from_file(WORD), mixed_texts(300, 9)
    want = [np.array(plain.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert WordBpe(WORD).ids(texts) == want


def test_byte_counts_equal_the_library():
    tokenizer, table = tokencount.library(BYTE)
    texts = mixed_texts(3000) + ["x <|endoftext|> y", "", "  ", "a" * 300]
    for c in map(chr, range(0x180)):
        texts += [c, f"a{c}b", f" {c}{c} x", f"1{c}'s {c}\n", f"  {c}  {c}", f"{c} {c}\n\n{c}"]
    assert tokencount.counts(texts, tokenizer, table) == [len(tokenizer.encode(t, add_special_tokens=False).ids) for t in texts]


def test_splices_equal_the_whole():
    tokenizer, _ = tokencount.library(BYTE)
    rnd = random.Random(1)
    texts = [
        "word " * 3000,
        "a" * 4000,
        " " * 3000 + "x" * 2000,
        "x  <|endoftext|> " * 200,
        "ab'll 12 \n\n  ñé!!" * 300,
        "".join(rnd.choice("ab '\n\t1é!<|>endoftxl  ") for _ in range(15_000)),
        ("lorem " * 50 + "z" * 900) * 6,
        "é" * 2000 + " " * 999 + "<|endoftext|>" * 50,
    ]
    for text in texts:
        want = tokenizer.encode(text, add_special_tokens=False).ids
        for chunk, overlap in ((500, 64), (300, 40), (1000, 256)):
            assert [i for part in tokencount.spliced(text, tokenizer, chunk, overlap) for i in part] == want


def test_token_counts(edge_docs, edge_rows, empty_docs):
    tokenizer, _ = tokencount.library(BYTE)
    got = sorted(map(tuple, tokencount.token_counts(edge_docs).collect()), key=str)
    want = []
    for row in edge_rows:
        text = row[1] or ""
        n = len(tokenizer.encode(text, add_special_tokens=False).ids)
        want.append((row[0], len(text.encode()), n, n > 512))
    assert got == sorted(want, key=str)
    assert tokencount.token_counts(empty_docs).count() == 0


def check_packing(rows, texts, limit):
    """Every id in one piece, sequences without gaps and within the limit."""
    plain = Tokenizer.from_file(WORD)
    ids = sorted((np.array([*plain.encode(t or "", add_special_tokens=False).ids, 2], "<u4").tobytes() for t in texts), key=len)
    pieces = sorted((r.doc_tokens, r.start, r.length, r.ids_crc32) for r in rows)
    want = sorted((len(b) // 4, s, min(limit, len(b) // 4 - s), zlib.crc32(b[4 * s : 4 * min(len(b) // 4, s + limit)])) for b in ids for s in range(0, len(b) // 4, limit))
    assert pieces == want
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= limit
    assert sorted(sequences) == list(range(len(sequences)))
    return sum(r.length for r in rows) / max(1, limit * len(sequences))


def test_packing_edge_cases(edge_docs, edge_rows, empty_docs):
    check_packing(packing.pack(edge_docs).collect(), [r[1] for r in edge_rows], 4096)
    assert packing.pack(empty_docs).count() == 0


def test_packing_whole_table(table):
    docs = table("documents")
    for limit in (4096, 64):
        fill = check_packing(packing.pack(docs.repartition(5), limit=limit).collect(), [r.text for r in docs.collect()], limit)
        assert fill > 0.95


def test_pack_lengths_is_whole():
    rnd = random.Random(2)
    for _ in range(30):
        histogram = {rnd.randint(1, 100): rnd.randint(1, 50) for _ in range(rnd.randint(0, 40))}
        patterns = packing.pack_lengths(histogram, 100)
        assert all(sum(lengths) <= 100 for _, lengths in patterns)
        back = {}
        for count, lengths in patterns:
            for length in lengths:
                back[length] = back.get(length, 0) + count
        assert back == histogram
