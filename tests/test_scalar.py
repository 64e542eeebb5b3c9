"""Scalar expressions at their edges (bands, NULLs, zero denominators)."""

import math

from pyspark.sql import functions as F

from burnlens.functions import scalar as S


def _one(spark, expr, schema, rows):
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.select(expr(df)).collect()]


def test_hour_bands_edges(spark):
    hours = [5, 8, 9, 12, 13, 16, 17, 20, 21, 0, 4, None]
    got = _one(spark, lambda d: S.hour_band("h"), "h int", [(h,) for h in hours])
    assert got == [
        "Morning Peak", "Morning Peak", "Late Morning", "Late Morning", "Afternoon", "Afternoon",
        "Evening Peak", "Evening Peak", "Night / Early", "Night / Early", "Night / Early", "Unknown",
    ]


def test_load_and_distance_bands(spark):
    loads = [0.5999, 0.60, 0.75, 0.85, 0.95, 1.0, None]
    got = _one(spark, lambda d: S.load_band("x"), "x double", [(x,) for x in loads])
    assert got == ["<60%", "60-75%", "75-85%", "85-95%", "95-100%", "95-100%", "Unknown"]
    dist = [799.9, 800.0, 1500.0, 2500.0, None]
    got = _one(spark, lambda d: S.distance_band("x"), "x double", [(x,) for x in dist])
    assert got == ["Short (<800 km)", "Medium (800-1500 km)", "Long (1500-2500 km)", "Ultra-long (>2500 km)", "Unknown"]


def test_cut_edges_right_closed(spark):
    got = _one(spark, lambda d: S.cut_edges("x", [-1, 8, 12], ["a", "b"]), "x int", [(0,), (8,), (9,), (12,), (13,), (None,)])
    assert got == ["a", "a", "b", "b", None, None]


def test_season(spark):
    got = _one(spark, lambda d: S.season("m"), "m int", [(m,) for m in [12, 1, 2, 3, 5, 6, 8, 9, 11]])
    assert got == ["Winter"] * 3 + ["Spring"] * 2 + ["Summer"] * 2 + ["Fall"] * 2


def test_load_factor_zero_capacity(spark):
    rows = [(0, 0), (5, 0), (100, 200), (300, 200), (None, 10)]
    got = _one(spark, lambda d: S.load_factor("p", "c"), "p int, c int", rows)
    assert got == [None, 1.0, 0.5, 1.0, None]


def test_route_parts(spark):
    rows = [("DUB-STN",), ("DUB",), ("A-B-C",), (None,)]
    df = spark.createDataFrame(rows, "r string")
    got = df.select(S.route_part("r", 0), S.route_part("r", 1), S.route_parts("r")).collect()
    assert [tuple(r) for r in got] == [("DUB", "STN", 2), ("DUB", None, 1), ("A", "B", 3), (None, None, None)]


def test_clip_keeps_null_and_safe_div(spark):
    df = spark.createDataFrame([(None, 0.0), (-5.0, 2.0), (3.0, 0.0)], "x double, d double")
    got = df.select(S.clip("x", lo=0.0).alias("c"), S.safe_div("x", "d").alias("q")).collect()
    assert [tuple(r) for r in got] == [(None, None), (0.0, -2.5), (3.0, None)]


def test_haversine_known_distance(spark):
    # Dublin (53.4213, -6.2701) to London Stansted (51.885, 0.235): ~468 km
    df = spark.createDataFrame([(53.4213, -6.2701, 51.885, 0.235)], "a double, b double, c double, d double")
    km = df.select(S.haversine_km("a", "b", "c", "d")).first()[0]
    assert 460 < km < 475


def test_sig_round(spark):
    vals = [123456.78912345, -0.000123456789012, 5.0, 0.0, None]
    got = _one(spark, lambda d: S.sig_round("x", 10), "x double", [(v,) for v in vals])
    assert math.isclose(got[0], 123456.7891, rel_tol=1e-12)
    assert math.isclose(got[1], -0.000123456789, rel_tol=1e-9)
    assert got[2] == 5.0 and got[3] == 0.0 and got[4] is None


def test_segment_name_null_drops(spark):
    df = spark.createDataFrame([("R", "NG"), ("R", None)], "a string, b string")
    got = [r[0] for r in df.select(S.segment_name(["a", "b"])).collect()]
    assert got == ["R | NG", None]


def test_fixed_sum_is_the_same_in_any_order_and_exact(spark):
    from decimal import Decimal

    vals = [1e11 + 0.1234, -1e11, 0.0001, 2.5e9 + 0.25, 7.00004, 7.00005, None, float("nan")] + [0.1] * 1000
    want = sum((Decimal(str(v)) for v in vals[:4]), Decimal(0)) + Decimal("7.0000") + Decimal("7.0001") + 100
    got = set()
    for order, parts in ((vals, 1), (vals[::-1], 3), (sorted(vals[:6]) + vals[6:], 7)):
        df = spark.createDataFrame([(v,) for v in order], "x double").repartition(parts)
        got.add(df.agg(S.fixed_sum("x").alias("t")).first().t)
    assert got == {float(want)}
    none = spark.createDataFrame([(None,), (float("nan"),)], "x double")
    assert none.agg(S.fixed_sum("x").alias("t")).first().t is None
    many = spark.range(3).select(F.lit(8e14).alias("x"))
    assert many.agg(S.fixed_sum("x").alias("t")).first().t == 2.4e15
