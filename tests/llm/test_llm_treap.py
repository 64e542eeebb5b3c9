import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from burnlens.llm import treap

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, items, k=50):
    """Every document scored for every item."""
    docs = [(i, Counter(terms(t))) for i, t in docs if i is not None]
    docs = [(i, c) for i, c in docs if c]
    total, size = len(docs), sum(sum(c.values()) for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    asked = {}
    for i, t in items:
        if i is not None:
            asked.setdefault(i, set()).update(terms(t))
    out = []
    for item, wanted in asked.items():
        scores = []
        for i, c in docs:
            m = 100 - 50 + (50 * sum(c.values()) * total) // size
            score = sum(math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 20 * m)) for t in wanted if t in c)
            if score > 0:
                scores.append((-score, i))
        out += [(item, rank, i, -s) for rank, (s, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


def texts(seed, n, longest=60):
    rnd = random.Random(seed)
    words = [f"w{k}" for k in range(300)] + ["Ünder", "ÄÖ", "naïve", "東京", "a_b", "\x85", "x\x7fy", "9"]
    return ["".join(w + rnd.choice([" ", "-", "\n", ". "]) for w in rnd.choices(words, weights=[1 / (k + 1) for k in range(len(words))], k=rnd.randint(0, longest))) for _ in range(n)]


DOCS = "doc_id long, text string, score long, `rank` int, df int, n int, item_id long"
ITEMS = "item_id long, text string, doc_id long, terms string, term int"


def rows_of(frame):
    return sorted(map(tuple, frame.collect()))


@pytest.fixture(scope="module")
def docs():
    out = list(enumerate(texts(1, 400)))
    out += [(1000, None), (1001, ""), (1002, " .,- "), (None, "w1 w2 w3 w4"), (7, out[7][1]), (7, out[8][1])]
    return out + [(2000 + k, out[3][1]) for k in range(80)] + [(3000, "w5 " * 20_000), (3001, "W5")]


@pytest.fixture(scope="module")
def items():
    out = list(enumerate(texts(2, 25, 30)))
    return out + [(100, None), (101, ""), (102, "absent words only"), (None, "w1"), (3, "w2 extra naïve"), (4, out[4][1]), (-5, "w5 W5 w5"), (103, "w0")]


@pytest.mark.parametrize("ranges,postings,block", [(4096, 1 << 20, 512), (16, 1 << 20, 7), (1, 1 << 20, 512), (300, 200, 512)])
def test_against_brute_force(spark, docs, items, ranges, postings, block):
    d = spark.createDataFrame([(i, t, 1, 2, 3, 4, 5) for i, t in docs], DOCS).repartition(3)
    asked = spark.createDataFrame([(i, t, 1, "x", 2) for i, t in items], ITEMS)
    got = treap.search(treap.build(d, range_documents=ranges, range_postings=postings), asked, block_items=block)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert rows_of(got) == plain(docs, items)


def test_small_k_and_narrow_limits(spark, docs, items, monkeypatch):
    monkeypatch.setattr(treap, "SPLIT", 3)
    monkeypatch.setattr(treap, "OPEN_CELLS", 20)
    rows = treap.Index
    d = spark.createDataFrame([(i, t, 1, 2, 3, 4, 5) for i, t in docs], DOCS)
    index = treap.build(d)
    assert isinstance(index, rows)
    treaps = [(treap.opened(r.asDict()), r) for r in index.ranges.collect()]
    wanted = {i: set(terms(t)) for i, t in items if i == 9}
    n = {t: c for t, c in treap.document_frequencies(index, sorted(wanted[9])).items()}
    held = (np.zeros(0, np.int64), np.zeros(0, np.int64))
    for cells, r in treaps:
        import zstandard

        spelled = [t.decode() for t in zstandard.decompress(r.terms).split(b" ")]
        here = [(spelled.index(t), treap.weight(index.documents, n[t])) for t in sorted(wanted[9]) if t in spelled]
        rows, weights = (np.array(x, np.int64) for x in zip(*here))
        held = treap.best_documents(cells, rows, weights, treap.unpacked(r.doc_ids, np.int64), held, 5)
    assert [(i, s) for s, i in zip(*map(list, held))] == [(r[2], r[3]) for r in plain(docs, [(i, t) for i, t in items if i == 9], 5)]


def test_cells_hold_the_largest_impact():
    rng = np.random.default_rng(1)
    grid = rng.integers(1, 1000, (40, 16)) * (rng.random((40, 16)) < 0.2)
    row, col = np.nonzero(grid)
    strips, masks, maxima, points = treap.cells(row, col, grid[row, col], 4)
    made = treap.opened(
        {"bits": 4, "strips": treap.packed(strips.astype(np.int32)), "masks": treap.packed(masks), "maxima": treap.packed(maxima.astype(np.int32)), "points": treap.packed(points.astype(np.int32))}
    )
    assert len(masks) < 3 * len(row) and (masks == 0).sum() == len(row) and maxima.min() >= 0
    rows = np.arange(40)
    at = made.roots(rows)
    for strip in range(3):
        block = grid[16 * strip : 16 * strip + 16]
        assert block.max() == made.top[at[16 * strip]] or (block > 0).sum() == 1
    cells, span = at[None, :], np.zeros(1, np.int64)
    for level in range(4):
        shift = np.full((len(cells), 1), 3 - level)
        cells = np.concatenate([made.quarters(cells, rows & 15, shift, span[:, None], half) for half in (0, 1)])
        span = np.concatenate([2 * span, 2 * span + 1])
    assert np.array_equal(made.top[cells][np.argsort(span)], grid.T)


def test_edge_documents(edge_docs, edge_rows, spark):
    items = [(1, edge_rows[0][1]), (2, edge_rows[8][1]), (3, "x" * 30_000), (4, "same row"), (5, "one two")]
    got = treap.query(edge_docs, spark.createDataFrame(items, "item_id long, text string"))
    assert rows_of(got) == plain([(r[0], r[1]) for r in edge_rows], items)


def test_whole_table_and_empty(table, empty_docs, spark):
    docs = [(r.doc_id, r.text) for r in table("documents").collect()]
    items = [(r.item_id, r.text) for r in table("benchmark").collect()]
    assert rows_of(treap.query(table("documents"), table("benchmark"))) == plain(docs, items)
    assert treap.query(empty_docs, table("benchmark")).count() == 0
    assert treap.query(table("documents"), table("benchmark").where("false")).count() == 0
