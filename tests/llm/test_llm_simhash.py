import random

import numpy as np
import pytest
import xxhash

from burnlens.llm import simhash
from burnlens.llm.common import components


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[k : k + 4]) for k in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(fps, most):
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(fps):
        for j in range(i):
            if (a ^ fps[j]).bit_count() <= most:
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return [find(k) for k in range(len(fps))]


def test_whole_table_matches_brute_force(table):
    docs = table("documents").toPandas()
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.query(table("documents")).collect()}
    fps = [plain_fingerprint(t) for t in docs.text]
    roots = plain_groups(fps, 4)
    lowest = {}
    for i, r in zip(docs.doc_id, roots):
        lowest[r] = min(lowest.get(r, 1 << 60), i)
    assert got == {i: (f"{f:016x}", lowest[r]) for i, f, r in zip(docs.doc_id, fps, roots)}


@pytest.mark.parametrize("thresholds", [None, [1, 0, 0, 0], [2, 1]])
def test_no_link_is_lost(spark, thresholds):
    rnd = random.Random(5)
    fps = []
    for _ in range(40):
        seed = rnd.getrandbits(64)
        for _ in range(6):
            x = seed
            for b in rnd.sample(range(64), rnd.randint(0, 6)):
                x ^= 1 << b
            fps.append(x)
    fps = sorted(set(fps))
    frame = spark.createDataFrame([(int(np.uint64(x).astype(np.int64)),) for x in fps], "fp long").repartition(3)
    together = simhash.bit_counts(frame)
    if thresholds is None:
        groups, thresholds = simhash.plan(together, len(fps))
    else:
        groups = simhash.partition_bits(together, len(fps), len(thresholds))
    assert sum(t + 1 for t in thresholds) == 5
    got = components(simhash.links(frame, groups, thresholds, 4, block_rows=16), "test")
    roots = {np.int64(r.node).astype(np.uint64): np.int64(r.root).astype(np.uint64) for r in got.collect()}
    want = {}
    for x, r in zip(fps, plain_groups(fps, 4)):
        want.setdefault(r, []).append(x)
    for members in want.values():
        assert len({int(roots.get(np.uint64(x), np.uint64(x))) for x in members}) == 1
    assert len({int(roots.get(np.uint64(x), np.uint64(x))) for x in fps}) == len(want)


def test_plan_skips_nothing():
    rng = np.random.default_rng(0)
    bits = rng.random((500, 64)) < 0.5
    bits[:, 1] = bits[:, 0]
    together = bits.T.astype(float) @ bits
    for n in (500, 10**7, 10**10):
        groups, thresholds = simhash.plan(together, n)
        assert sum(t + 1 for t in thresholds) == 5
        assert len({b for g in groups for b in g}) == sum(map(len, groups))
    assert any({0, 1} <= set(g) for g in simhash.partition_bits(together, 500, 8))


def test_edge_cases(edge_docs, edge_rows):
    got = simhash.simhash_groups(edge_docs).collect()
    assert len(got) == len(edge_rows)
    by_id = {}
    for r in got:
        by_id.setdefault(r.doc_id, []).append((r.fp, r.component_id))
    assert by_id[2] == by_id[3] == by_id[7] == [(0, 2)]
    assert by_id[1] == by_id[9] and by_id[9][0][1] == 1
    assert len(by_id[5]) == 2 and by_id[5][0] == by_id[5][1] and by_id[5][0][1] == 5
    assert by_id[None][0][1] is None


def test_keep_one(edge_docs):
    kept = simhash.keep_one(edge_docs)
    assert kept.columns == edge_docs.columns
    ids = sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect())
    assert ids == sorted((i is None, i or 0) for i in (1, 2, 4, 5, None, 8, 10, 11))


def test_empty(empty_docs):
    assert simhash.simhash_groups(empty_docs).count() == 0
    assert simhash.keep_one(empty_docs).count() == 0
