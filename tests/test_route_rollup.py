"""The route table from one aggregate by (route, type) against pandas."""

import numpy as np
import pandas as pd
import pytest

from burnlens.operators import segments


def test_route_rollup_equals_pandas(spark):
    rng = np.random.default_rng(5)
    n = 900
    pdf = pd.DataFrame({"ScheduledRoute": rng.choice(["A-B", "A-C", "B-C", None], n), "AircraftTypeGroup": rng.choice(["x", "y", "z", None], n)})
    for c in segments.ROUTE_MEANS:
        pdf[c] = rng.normal(100, 50, n)
    pdf["Residual_kg"] = rng.normal(1e3, 5, n)
    pdf.loc[::11, ["ExcessBurn_kg", "LoadFactor", "Residual_kg"]] = np.nan
    pdf["IsAnomaly"] = rng.random(n) < 0.2
    pdf["IsOverburnAnomaly"] = pdf.IsAnomaly & (rng.random(n) < 0.5)
    # a route of one row without a type, and one whose types tie
    extra = pdf.head(3).copy()
    extra["ScheduledRoute"], extra["AircraftTypeGroup"] = ["S-T", "T-T", "T-T"], [None, "y", "x"]
    pdf = pd.concat([pdf, extra], ignore_index=True)
    schema = ", ".join(f"{c} {'string' if i < 2 else 'boolean' if c.startswith('Is') else 'double'}" for i, c in enumerate(pdf))
    rows = [tuple(None if v is None or v != v else v for v in r) for r in pdf.itertuples(index=False)]
    got = segments.route_opportunity(spark.createDataFrame(rows, schema).repartition(5)).toPandas().set_index("ScheduledRoute")
    groups = pdf.dropna(subset=["ScheduledRoute"]).groupby("ScheduledRoute")
    assert set(got.index) == set(groups.groups)
    for route, g in groups:
        r = got.loc[route]
        assert r.FlightCount == len(g)
        types = g.AircraftTypeGroup.dropna()
        assert r.AircraftTypeMode == (types.mode().min() if len(types) else "Unknown")
        for c, name in segments.ROUTE_MEANS.items():
            assert r[name] == pytest.approx(g[c].mean(), rel=1e-12, nan_ok=True)
        assert r.MedianExcessBurn == pytest.approx(g.ExcessBurn_kg.median(), rel=1e-12, nan_ok=True)
        assert r.P90ExcessBurn == pytest.approx(g.ExcessBurn_kg.quantile(0.9), rel=1e-12, nan_ok=True)
        assert r.ResidualStd == pytest.approx(g.Residual_kg.std(ddof=0), rel=1e-6, nan_ok=True)
        assert r.RouteRMSE == pytest.approx(np.sqrt((g.ExcessBurn_kg**2).mean()), rel=1e-12, nan_ok=True)
        assert r.PositiveExcessRate == pytest.approx((g.ExcessBurn_kg > 0).mean())
        assert r.AnomalyRate == pytest.approx(g.IsAnomaly.mean())
        assert r.TotalAvoidableCost_eur == pytest.approx(g.AvoidableFuelCost_eur.round(4).sum(), rel=1e-9)


def test_grouped_quantiles_written_or_not(spark):
    from burnlens.functions.quantile import exact_quantiles

    rng = np.random.default_rng(6)
    pdf = pd.DataFrame({"g": rng.choice(["a", "b"], 3000, p=[0.9, 0.1]), "v": np.round(rng.normal(0, 10, 3000), 1)})
    df, probs = spark.createDataFrame(pdf), {"q": 0.1, "m": 0.5, "p": 0.995}
    lazy, written = (exact_quantiles(df, "v", probs, by=["g"], write=w).toPandas().set_index("g").sort_index() for w in (False, True))
    assert lazy.equals(written)
    for name, p in probs.items():
        assert np.allclose(written[name], pdf.groupby("g").v.quantile(p), rtol=0, atol=1e-12)
