import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from burnlens.llm import collocations

BREAKS = re.compile(r"[.,;:!?\x0A-\x0D]")


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def plain(rows, least=30, top=2000):
    """Rows of the query from ``(text, lang)`` rows, counted one by one."""
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in BREAKS.split(lower(text)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, 5):
                f.update((lang, tuple(w[i : i + k])) for i in range(len(w) - k + 1))
    often = {p: c for p, c in f.items() if c >= least}
    longest = defaultdict(int)
    for (lang, w), c in often.items():
        for s in range(2, len(w)):
            for i in range(len(w) - s + 1):
                longest[lang, w[i : i + s]] = max(longest[lang, w[i : i + s]], c)
    out = []
    for (lang, w), a in often.items():
        if len(w) > 1 and 100 * longest[lang, w] < 80 * a:
            score, cut = min((2_000_000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k) for k in range(1, len(w)))
            out.append((lang, " ".join(w), a, f[lang, w[:cut]], f[lang, w[cut:]], n[lang], score))
    result = []
    for lang in {r[0] for r in out}:
        best = sorted((r for r in out if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode()))[:top]
        result += [(lang, k, *r[1:]) for k, r in enumerate(best, 1)]
    return sorted(result)


def rows_of(frame):
    return sorted(map(tuple, frame.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()))


def prose(seed, n, vocabulary=12):
    rnd = random.Random(seed)
    words = [f"w{k}" for k in range(vocabulary)] + ["Ünder", "ÄÖ", "x\x00y", "naïve", "東京", "a|b", "\x85"]
    out = []
    for _ in range(n):
        w = rnd.choices(words, weights=[1 / (k + 1) for k in range(len(words))], k=rnd.randint(0, 120))
        out.append("".join(x + rnd.choice([" "] * 40 + ["\t", "  ", ". ", ",", "\n", "; ", ":", "!", "?", "\x0b"]) for x in w))
    return out


SCHEMA = "doc_id long, text string, lang string, phrase string, a int, h long, c long, rank int, w array<int>"


def frame(spark, rows):
    return spark.createDataFrame([(k, t, lang, "p", 1, 2, 3, 4, [5]) for k, (t, lang) in enumerate(rows)], SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(1)
    out = [(t, rnd.choice(["en", "en", "en", "de", None])) for t in prose(2, 900)]
    out += [(None, "en"), ("", None), ("Big Apple pie", "")] + [("Big apple PIE for sale, now", "en")] * 60 + [("only here", "xx")] * 29
    return out


@pytest.mark.parametrize("sample_every,lowered", [(8, 0.6), (2, 0.01), (3, 5.0), (10**9, 1.0)])
def test_any_sample_gives_the_exact_counts(spark, rows, sample_every, lowered):
    """Too many proposals, too few and none at all: the border passes make up for it."""
    got = collocations.collocations(frame(spark, rows), sample_every=sample_every, lowered=lowered)
    want = plain(rows)
    assert len(want) > 100 and len({r[0] for r in want}) >= 3
    assert rows_of(got) == want


def test_ranking_stops_and_ties(spark, rows):
    got = collocations.collocations(frame(spark, rows), min_count=5, top=7)
    assert rows_of(got) == plain(rows, 5, 7)


@pytest.mark.parametrize("window", [7, 64, 1 << 20])
def test_windows_do_not_show(spark, rows, window):
    docs = frame(spark, rows).selectExpr("text", "coalesce(lang, 'und') AS lang").where("text IS NOT NULL")
    small = collocations.hashed_counts(docs, "short", 3, 2, window=window).collect()
    whole = collocations.hashed_counts(docs, "short", 1, 2).collect()
    assert sorted(map(tuple, small)) == sorted(map(tuple, whole)) and len(whole) > 100


def test_long_texts_are_cut_at_spaces(monkeypatch):
    monkeypatch.setattr(collocations, "SLICE", 50)
    text = " ".join(prose(5, 30)) + " " + "q" * 500 + " end. " + "z" * 80
    words, hashes = [b"."], [0]
    got = collocations.numbers(text.encode(), collocations.Vocabulary(words, hashes, b"en"))
    spelled = [words[k].decode() for k in got if k]
    assert spelled == [w for piece in BREAKS.split(lower(text)) for w in re.findall(r"[^\x20\x09]+", piece)]


def test_scores_past_64_bits(spark):
    big = 5_000_000_000_000_000
    counts = spark.createDataFrame([("en", "a b", big), ("en", "a", big + 1), ("en", "b", big), ("en", "", 3 * big)], "lang string, phrase string, c long")
    assert rows_of(collocations.ranked(counts)) == [("en", 1, "a b", big, big + 1, big, 3 * big, 2_000_000 * big // (2 * big + 1))]


def test_bitmap_misses_nothing(spark):
    hashes = np.random.default_rng(3).integers(-(2**63), 2**63, 5000)
    made = collocations.bitmap(spark.createDataFrame([(int(h),) for h in hashes], "h long"), 5000)
    assert made.has(hashes.view(np.uint64)).all()
    others = np.random.default_rng(4).integers(0, 2**63, 5000).view(np.uint64)
    assert made.has(others).mean() < 0.05


def test_edge_documents(edge_docs, edge_rows):
    got = collocations.collocations(edge_docs, min_count=2)
    assert rows_of(got) == plain([(r[1], r[2]) for r in edge_rows], 2)


def test_whole_table_and_empty(table, empty_docs):
    docs = [(r.text, r.lang) for r in table("documents").collect()]
    assert rows_of(collocations.query(table("documents"))) == plain(docs)
    assert collocations.query(empty_docs).count() == 0
