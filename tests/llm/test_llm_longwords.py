"""Long words of two letters that sums of powers can't tell apart, and other long stretches."""

import numpy as np
import pytest

from burnlens.llm import topk, toxicity
from burnlens.llm.wordhash import prefix_sums, stretch_hash, word_bounds


def alternating(n: int, a: str, b: str) -> str:
    """The Thue-Morse word of ``n`` letters."""
    return "".join(b if k.bit_count() % 2 else a for k in range(n))


PAIRS = [(alternating(n, "a", "b"), alternating(n, "b", "a")) for n in (64, 256, 512, 1024, 2048, 4096)]


@pytest.mark.parametrize("one,two", PAIRS, ids=lambda w: str(len(w)))
def test_hashes_differ_and_do_not_depend_on_the_place(one, two):
    buf = np.frombuffer(f"{one} {two} x {one} {two}".encode(), np.uint8)
    h = stretch_hash(prefix_sums(buf), *word_bounds(buf))
    assert h[0] != h[1] and (h[0], h[1]) == (h[3], h[4])


@pytest.mark.parametrize("one,two", PAIRS, ids=lambda w: str(len(w)))
def test_tokenizers_and_counts(spark, one, two):
    import public_tokenizers
    from tokenizers import Tokenizer

    from burnlens.llm import packing, tokencount

    texts = [one, two, f"{one} {two}", f"{two}. {one}"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    bytewise = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
    counts = {r.doc_id: r.n_tokens for r in tokencount.query(docs).collect()}
    assert counts == {k: len(bytewise.encode(t, add_special_tokens=False).ids) for k, t in enumerate(texts)}
    words = Tokenizer.from_file(str(public_tokenizers.path("word_bpe_49k.json")))
    import zlib

    packed = packing.query(docs).collect()
    for k, t in enumerate(texts):
        ids = np.array([*words.encode(t, add_special_tokens=False).ids, 2], "<u4")
        for r in (r for r in packed if r.doc_id == k):
            assert r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())


@pytest.mark.parametrize("one,two", [PAIRS[3]], ids=lambda w: str(len(w)))
def test_known_words_are_those_of_training(spark, one, two):
    from zlib import crc32

    from burnlens.llm import lm

    held = next(k for k in range(100) if crc32(str(k).encode()) % 10 == 0)
    rows = [(k, one) for k in range(100, 140) if crc32(str(k).encode()) % 10] + [(held, two)]
    got = {r.doc_id: r.n_known for r in lm.query(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[held] == 1


def test_sketch_is_of_one_text_alone():
    texts = [b"", b"idiot", b"you idiot", b"one two three", b"one two three four", b"idiot", b"a b", b"the end of it"]
    alone = [int(toxicity.sketch([t])[0]) for t in texts]
    for order in ([7, 1, 3, 0, 2, 5, 6, 4], list(range(8)), list(range(7, -1, -1))):
        assert toxicity.sketch([texts[k] for k in order]).tolist() == [alone[k] for k in order]
    assert alone[1] == alone[5] and len(set(alone)) == 7


def test_scores_past_62_bits_stop_the_job(spark):
    for v in ([1e300], [2.0**30]):
        rows = [(0, v), (1, v)]
        with pytest.raises(Exception, match="62 bits"):
            topk.query(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
