"""Segment engine on hand-made fixtures: first-match fallback, the n = 7 / 8
threshold, std 0 -> global std, NULL keys, strict z thresholds, mode ties,
opportunity score."""

import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from burnlens import config as C
from burnlens.operators import segments, value


def _fixture(spark):
    rows = []
    # route R1 x NG: 8 rows -> route x aircraft level
    for i in range(8):
        rows.append(("R1", "NG", "R1o", "Morning Peak", "Winter", float(i)))
    # route R2 x Max: 7 rows (too small) but route R2 has 7+1 = 8 -> route level
    for i in range(7):
        rows.append(("R2", "Max", "R2o", "Afternoon", "Winter", 10.0 + i))
    rows.append(("R2", "NG", "R2o", "Afternoon", "Winter", 50.0))
    # route R3: 3 rows, all equal residual; type "Airbus" only here -> falls to season
    for _ in range(3):
        rows.append(("R3", "Airbus", "R3o", "Evening Peak", "Summer", 5.0))
    # NULL route: cannot match route levels
    rows.append((None, "NG", None, "Night / Early", "Fall", 1.0))
    return spark.createDataFrame(
        rows, "ScheduledRoute string, AircraftTypeGroup string, Origin string, DepartureHourBand string, Season string, Residual_kg double"
    )


def test_first_match_fallback(spark):
    df = _fixture(spark)
    out = segments.segment_zscores(df).toPandas()
    basis = out.groupby(["ScheduledRoute", "AircraftTypeGroup"], dropna=False)["SegmentBasis"].first().to_dict()
    assert basis[("R1", "NG")] == "Route × Aircraft"
    assert basis[("R2", "Max")] == "Route"
    assert basis[("R2", "NG")] == "Route"
    # NG has 8 (R1) + 1 (R2) + 1 (NULL route) = 10 rows -> aircraft level for the NULL-route row
    assert out[out.ScheduledRoute.isna()].SegmentBasis.iloc[0] == "Aircraft"
    # R3/Airbus: 3 rows; no level reaches 8 except ... season Summer has 3 -> global
    assert basis[("R3", "Airbus")] == "Global"


def test_route_level_stats_and_std_fallback(spark):
    df = _fixture(spark)
    out = segments.segment_zscores(df).toPandas()
    r2 = out[out.ScheduledRoute == "R2"]
    vals = np.array([10.0 + i for i in range(7)] + [50.0])
    assert np.allclose(r2.ResidualMean_segment, vals.mean())
    assert np.allclose(r2.ResidualStd_segment, vals.std(ddof=0))
    all_vals = df.toPandas().Residual_kg
    gstd = all_vals.std(ddof=0)
    g = out[out.SegmentBasis == "Global"]
    assert np.allclose(g.ResidualStd_segment, gstd)
    assert np.allclose(out.ResidualZ_global, (out.Residual_kg - all_vals.mean()) / gstd)


def test_zero_std_segment_uses_global_std(spark):
    rows = [("R", "T", "O", "Afternoon", "Winter", 7.0)] * 8 + [("S", "U", "P", "Afternoon", "Summer", 1.0)]
    df = spark.createDataFrame(
        rows, "ScheduledRoute string, AircraftTypeGroup string, Origin string, DepartureHourBand string, Season string, Residual_kg double"
    )
    out = segments.segment_zscores(df).toPandas()
    gstd = pd.Series([7.0] * 8 + [1.0]).std(ddof=0)
    r = out[out.ScheduledRoute == "R"]
    assert (r.SegmentBasis == "Route × Aircraft").all()
    assert np.allclose(r.ResidualStd_segment, gstd)
    assert np.allclose(r.ResidualZ_segment, 0.0)


def test_strict_z_threshold_and_issue_cascade(spark):
    rows = [(-2.5, 10.0, 600.0, 200.0, 0.0), (-2.5001, 10.0, 600.0, 200.0, 0.0), (2.6, 10.0, 600.0, 200.0, 900.0),
            (0.0, 10.0, 400.0, 200.0, 0.0), (None, 10.0, 600.0, 200.0, 0.0)]
    df = spark.createDataFrame(rows, "ResidualZ_segment double, AbsError_kg double, ActualBurn_kg double, RouteDistanceKm double, OpsPlanningGap_kg double")
    out = value.classify_anomalies(df).collect()
    assert [r.IsOverburnAnomaly for r in out] == [False, True, False, False, False]
    assert [r.IsUnderburnAnomaly for r in out] == [False, False, True, False, False]
    assert [r.LikelyIssueClass for r in out] == [
        "Normal", "Operational over-burn", "Planning conservatism / fuel policy", "Possible data-quality issue", "Normal",
    ]


def test_group_mode_tie_takes_smallest(spark):
    df = spark.createDataFrame([("r", "b"), ("r", "a"), ("r", "b"), ("r", "a"), ("s", None)], "g string, t string")
    got = {r.g: r.m for r in segments.group_mode(df, ["g"], "t", "m").collect()}
    assert got == {"r": "a"}


def test_opportunity_score_formula(spark):
    rows = [("a", 1000.0, 0.5, 10, 2.0), ("b", 500.0, 1.0, 1, 4.0), ("c", None, 0.2, 100, None)]
    df = spark.createDataFrame(rows, "k string, cost double, rate double, n long, sd double")
    out = {r.k: r.OpportunityScore for r in segments.opportunity_score(df, "cost", "rate", "n", "sd").collect()}
    med = 3.0  # median of 2 and 4 (NULL skipped)

    def score(cost, rate, n, sd):
        stab = 0.0 if sd is None else min(max(1 - sd / (med + 1e-9), 0), 1)
        return (cost or 0.0) * (rate or 0.0) * max(math.log1p(n), 1.0) * (0.5 + 0.5 * stab)

    for k, cost, rate, n, sd in rows:
        assert math.isclose(out[k], score(cost, rate, n, sd), rel_tol=1e-12)


def test_segment_long_drops_null_keys(spark):
    df = _fixture(spark)
    long = segments.segment_long(df, [("Route", ["ScheduledRoute"]), ("Aircraft", ["AircraftTypeGroup"])], ["Residual_kg"])
    counts = {r.SegmentType: r["count"] for r in long.groupBy("SegmentType").count().collect()}
    assert counts == {"Route": 19, "Aircraft": 20}


def test_scenarios_generator(spark):
    df = spark.createDataFrame([("Route", "x", 100.0, 2.0, 0.8)], "SegmentType string, SegmentName string, AnnualAvoidableCost_eur double, AnnualAvoidableCO2_t double, PositiveExcessRate double")
    out = {r.Scenario: (r.SavingsPotential_eur, r.SavingsPotential_CO2_t) for r in segments.intervention_scenarios(df).collect()}
    assert out[C.SCENARIOS[0][0]] == (25.0, 0.5)
    assert out[C.SCENARIOS[1][0]] == (50.0, 1.0)
    assert np.allclose(out[C.PEER_SCENARIO], (30.0, 0.6))
