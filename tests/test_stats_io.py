"""Statistics against numpy / pandas, and sources / sinks round trips."""

import os
import tempfile

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from burnlens.operators import residuals, stats
from burnlens.sources import io


def test_histogram_matches_numpy(spark):
    rng = np.random.default_rng(1)
    v = rng.gamma(2.0, 1000.0, 5000)
    out = stats.histogram(spark.createDataFrame(pd.DataFrame({"x": v})), "x", 80).orderBy("Bin").toPandas()
    counts, edges = np.histogram(v, bins=80)
    assert out.Count.sum() == len(v)
    assert np.allclose(out.Low, edges[:-1]) and np.allclose(out.High, edges[1:])
    assert np.abs(out.Count.values - counts).sum() <= 2  # float edge placement only


def test_equal_width_bins_match_pd_cut(spark):
    rng = np.random.default_rng(2)
    v = rng.uniform(0.2, 1.0, 2000)
    out = residuals.equal_width_bins(spark.createDataFrame(pd.DataFrame({"x": v})), "x", 10).toPandas()
    cats = pd.cut(v, bins=10)
    codes = pd.Series(cats.codes + 1)
    assert (out.sort_values("x").Bin.values == codes.values[np.argsort(v)]).mean() > 0.999
    mids = np.array([c.mid for c in cats])
    # pandas rounds interval edges to 3 significant digits for its labels
    assert np.allclose(out.sort_values("x").BinMid.values, mids[np.argsort(v)], atol=1e-3)


def test_corr_long_pairwise_nulls(spark):
    pdf = pd.DataFrame({"a": [1.0, 2.0, 3.0, 4.0, None], "b": [2.0, 4.1, 5.9, 8.2, 1.0], "c": [None, 1.0, 0.0, 1.0, 0.0]})
    out = stats.corr_long(spark.createDataFrame(pdf), ["a", "b", "c"]).toPandas()
    want = pdf.corr()
    for r in out.itertuples():
        assert np.isclose(r.Corr, want.loc[r.FeatureA, r.FeatureB], equal_nan=True)


def test_vif_matches_closed_form(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(3000, 3)) + 5
    x[:, 2] += 0.5 * x[:, 0]
    out = {r.Feature: r.VIF for r in stats.vif(spark.createDataFrame(pd.DataFrame(x, columns=list("abc"))), list("abc")).collect()}
    for i, c in enumerate("abc"):
        others = [j for j in range(3) if j != i]
        coef, *_ = np.linalg.lstsq(x[:, others], x[:, i], rcond=None)
        r2 = 1 - ((x[:, i] - x[:, others] @ coef) ** 2).sum() / (x[:, i] ** 2).sum()
        assert np.isclose(out[c], 1 / (1 - r2), rtol=1e-6)


def test_vif_singular_is_inf(spark):
    rng = np.random.default_rng(5)
    a, b = rng.normal(size=500), rng.normal(size=500)
    pdf = pd.DataFrame({"a": a, "b": b, "d": a - b})
    out = {r.Feature: r.VIF for r in stats.vif(spark.createDataFrame(pdf), ["a", "b", "d"]).collect()}
    assert all(np.isinf(v) for v in out.values())


def test_csv_round_trip_and_required(spark):
    d = tempfile.mkdtemp(prefix="bl-io-")
    src = os.path.join(d, "train.csv")
    with open(src, "w") as fh:
        fh.write(",".join(f.name for f in io.RAW_SCHEMA.fields) + "\n")
        fh.write("F1,DUB-STN,2023-01-05 07:30:00,2023-01-05 08:45:00,NG,FR,Sched,189,150,10,2,,75,3600,60000,55000,64000,2500\n")
    p = io.resolve_path(None, [os.path.join(d, "missing.csv"), src])
    df = io.read_fact_csv(spark, p)
    r = df.first()
    assert r.DepartureScheduled.hour == 7 and r.Freight is None and r.Burnoff == 2500.0
    out = io.write_table(df, os.path.join(d, "out"), partition_by=["Carrier"])
    assert io.read_required(spark, out, "stage 1").count() == 1
    assert io.read_optional(spark, os.path.join(d, "nope")) is None
    with pytest.raises(io.MissingInput):
        io.read_required(spark, os.path.join(d, "nope"), "stage 1")
    with pytest.raises(io.MissingInput, match="no input"):
        io.resolve_path(None, [os.path.join(d, "x.csv")])


def test_baseline_binding_by_key(spark):
    fact = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "FlightID string, y double")
    base = spark.createDataFrame([("b", 7, 20.0), ("a", 9, 10.0)], "FlightID string, n int, predicted_fuel double")
    assert io.pick_prediction_column(base.schema, ["FlightID"]) == "predicted_fuel"
    got = {r.FlightID: r.Baseline_pred for r in io.attach_baseline(fact, base, "FlightID").collect()}
    assert got == {"a": 10.0, "b": 20.0}
