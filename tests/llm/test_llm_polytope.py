import math
import random

import numpy as np
import pytest

from burnlens.llm import polytope

SCHEMA = "vec_id long, embedding array<float>, n long, v array<int>, node long, own boolean, links long"


def plain(rows, threshold=0.9):
    """(vec_id, n_links, component_id, kept) of every row, from all pairs."""
    good = [v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v) for _, v in rows]
    vec = [np.array(v, np.float64) / max(abs(x) for x in v) if g else None for (_, v), g in zip(rows, good)]
    root = list(range(len(rows)))
    links = [0] * len(rows)

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i, a in enumerate(vec):
        for j in range(i):
            b = vec[j]
            if a is None or b is None or len(a) != len(b):
                continue
            if a @ b / (math.sqrt(a @ a) * math.sqrt(b @ b)) >= threshold:
                links[i] += 1
                links[j] += 1
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    low = {}
    for k, (i, _) in enumerate(rows):
        low.setdefault(find(k), []).append(i)
    out = []
    for k, (i, _) in enumerate(rows):
        ids = [x for x in low[find(k)] if x is not None]
        least = min(ids) if ids else None
        out.append((i, links[k], least, i is not None and i == least))
    return sorted(out, key=str)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, [2], 3, True, 4) for i, v in rows], SCHEMA).repartition(5)


def clusters(seed, groups, members, width=64, noise=0.16):
    rng = np.random.default_rng(seed)
    rows = []
    for _ in range(groups):
        centre = rng.standard_normal(width)
        rows += [np.float32(centre + noise * rng.standard_normal(width)).tolist() for _ in range(members)]
    return list(enumerate(rows))


def test_edge_cases_against_brute_force(spark):
    rows = clusters(1, 12, 6)
    rows += [(100, None), (101, []), (102, [0.0] * 64), (103, [math.nan] + [1.0] * 63), (104, [math.inf] * 64), (105, [1.0, None]), (None, None)]
    rows += [(None, rows[3][1]), (3, rows[3][1]), (3, rows[3][1]), (-7, [2 * x for x in rows[9][1]]), (106, [-x for x in rows[9][1]])]
    rows += [(107, [1.0, 2.0, 3.0]), (108, [1.0, 2.0, 3.1]), (109, [5.0]), (110, [1e-30]), (111, [-1.0]), (112, [-0.0, 1.0]), (113, [0.0, 1.0])]
    rows += [(114, [3e38] * 8), (115, [3e38] * 7 + [2.9e38])]
    got = polytope.near_duplicates(frame(spark, rows))
    assert sorted(map(tuple, got.collect()), key=str) == plain(rows)


@pytest.mark.parametrize("block_rows", [16, 4096])
def test_a_large_group_is_counted_once_in_any_blocks(spark, block_rows):
    rows = clusters(2, 1, 120, noise=0.25) + [(1000 + k, v) for k, v in clusters(3, 40, 1)]
    got = polytope.near_duplicates(frame(spark, rows), block_rows=block_rows, load=4)
    found, want = sorted(map(tuple, got.collect())), sorted(plain(rows))
    assert sum(r[1] for r in want) > 10_000
    assert sum(r[1] for r in found) >= 0.99 * sum(r[1] for r in want)
    assert all(f[1] <= w[1] for f, w in zip(found, want)) and [f[2] for f in found] == [w[2] for w in want]


def test_recall_at_the_threshold(spark):
    rng = np.random.default_rng(5)
    rows = []
    for k in range(1500):
        x = rng.standard_normal(64)
        x /= math.sqrt(x @ x)
        z = rng.standard_normal(64)
        z -= (z @ x) * x
        z /= math.sqrt(z @ z)
        rows += [(2 * k, x.tolist()), (2 * k + 1, (0.9001 * x + math.sqrt(1 - 0.9001**2) * z).tolist())]
    got = {r.vec_id: r for r in polytope.near_duplicates(frame(spark, rows), load=2).collect()}
    met = [got[2 * k + 1].component_id == 2 * k for k in range(1500)]
    assert np.mean(met) > 0.98
    assert sum(r.n_links for r in got.values()) == 2 * sum(met)


def test_schemes_grow_with_the_rows():
    sizes = [polytope.scheme(64, n) for n in (10, 10_000, 10**7, 10**11)]
    buckets = [(2 * 64) ** (s.k - 1) * 2 * s.last for s in sizes]
    assert buckets == sorted(buckets) and all(32 * b >= n for b, n in zip(buckets, (10, 10_000, 10**7, 10**11)))
    assert [s.tables for s in sizes] == sorted(s.tables for s in sizes)
    one = sizes[2]
    x = np.random.default_rng(0).standard_normal((50, 64))
    whole = one.buckets(x, 1)
    assert np.array_equal(whole[7:9], one.buckets(x[7:9], 1)) and all(len(set(r)) == 5 for r in whole)


def test_rotation_keeps_lengths():
    x = np.random.default_rng(1).standard_normal((5, 32))
    y = polytope.hadamard(x)
    assert np.allclose((x * x).sum(1), (y * y).sum(1)) and np.allclose(polytope.hadamard(y), x)


def test_whole_table_and_empty(table, spark):
    rows = [(r.vec_id, r.embedding) for r in table("embeddings").collect()]
    assert sorted(map(tuple, polytope.query(table("embeddings")).collect()), key=str) == plain(rows)
    rnd = random.Random(3)
    rows += [(10_000 + k, [x + rnd.gauss(0, 0.004) for x in rows[k % 7][1]]) for k in range(60)]
    assert sorted(map(tuple, polytope.query(frame(spark, rows)).collect()), key=str) == plain([(i, np.float32(v).tolist()) for i, v in rows])
    assert polytope.query(table("embeddings").where("false")).count() == 0
