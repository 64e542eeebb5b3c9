import math
import random

from pyspark.sql import functions as F

from burnlens.llm import topk

SCHEMA = "vec_id long, embedding array<float>, score double, `rank` int, query_id long, v array<int>"


def plain(rows, is_query, k=10):
    good = sorted({(i, tuple(math.floor(1024 * x) for x in v)) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)})
    out = []
    for q, a in [r for r in good if is_query(r[0])]:
        found = sorted({(-sum(x * y for x, y in zip(a, b)), i) for i, b in good if i != q})[:k]
        out += [(q, n, i, -s) for n, (s, i) in enumerate(found, 1)]
    return sorted(out)


def test_edge_cases_against_brute_force(spark):
    rnd = random.Random(4)
    rows = [(i, [rnd.choice([0.0, 0.0, 0.25, -0.5, 1.0]) for _ in range(rnd.choice([0, 3, 5]))]) for i in range(60)]
    rows += [(100, None), (101, [1.0, None]), (102, [math.nan]), (103, [math.inf, 1.0]), (None, [1.0]), (7, rows[7][1]), (8, rows[8][1]), (200, [1.0] * 5), (201, [1.0] * 5), (202, [1.0] * 5)]
    frame = spark.createDataFrame([(i, v, 0.5, 1, 2, [3]) for i, v in rows], SCHEMA).repartition(5)
    for block in (1024, 7):
        got = topk.top_k(frame, F.col("vec_id") % 4 == 0, block_queries=block)
        assert sorted(map(tuple, got.collect())) == plain(rows, lambda i: i % 4 == 0)


def test_huge_components_do_not_overflow_the_selection(spark):
    rows = [(i, [float(x)]) for i, x in enumerate([1.0, 2.0**20, -(2.0**20), 2.0**19, 5.0])]
    frame = spark.createDataFrame([(i, v, 0.5, 1, 2, [3]) for i, v in rows], SCHEMA)
    assert sorted(map(tuple, topk.top_k(frame, F.col("vec_id") == 1, k=2).collect())) == plain(rows, lambda i: i == 1, 2)


def test_fewer_candidates_than_k_and_empty(spark):
    frame = spark.createDataFrame([(0, [1.0], 0.5, 1, 2, [3]), (1, [1.0], 0.5, 1, 2, [3])], SCHEMA)
    assert [tuple(r) for r in topk.query(frame).collect()] == [(0, 1, 1, 1024 * 1024)]
    assert topk.query(frame.where("false")).count() == 0


def test_whole_table(table):
    rows = [(r.vec_id, r.embedding) for r in table("embeddings").collect()]
    assert sorted(map(tuple, topk.query(table("embeddings")).collect())) == plain(rows, lambda i: i % 100 == 0)
