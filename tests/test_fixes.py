"""Hand-computed values of the tables that follow the dashboard's own formulas,
ties in exact quantiles, and storage rules."""

import types

import numpy as np
import pytest
from pyspark.sql import functions as F

from burnlens.functions.quantile import bucket, exact_quantiles
from burnlens.operators import ml, residuals, stats, tables
from burnlens.session import checkpoint_dir
from burnlens.sources import io


def test_std_is_of_the_signed_residual(spark):
    df = spark.createDataFrame([("a", -2.0), ("a", 2.0), ("a", 0.0), ("b", 5.0)], "k string, Residual double").withColumn("AbsError", F.abs("Residual"))
    rows = {r.k: r for r in residuals.error_by_group(df, "k").collect()}
    assert rows["a"].StdResid == 2.0  # of -2, 2, 0; of the absolute errors it would be 1.1547
    assert rows["a"].MeanAbsError == pytest.approx(4 / 3) and rows["a"].Rows == 3
    half = 1.96 * np.std([2, 2, 0], ddof=1) / np.sqrt(3)
    assert rows["a"].CIHigh - rows["a"].MeanAbsError == pytest.approx(half)
    assert rows["b"].StdResid is None


def test_tolerance_floors_the_actual_at_one(spark):
    df = spark.createDataFrame([(0.0, 0.04), (0.5, 0.56), (100.0, 104.0), (100.0, 106.0)], "y double, p double")
    row = residuals.within_tolerance(df, "y", "p").first()
    # |e| / max(|y|, 1): 0.04, 0.06, 0.04, 0.06; an actual of 0 is no error.
    assert row.WithinTolShare == 0.5 and row.Rows == 4


def test_drift_summary_clips_and_takes_the_population_std(spark):
    df = spark.createDataFrame([(-4.0,), (2.0,), (6.0,), (8.0,)], "prediction double")
    row = ml.drift_summary(df, reference_mean=4.0).first()
    assert (row.Negatives, row.N, row.Min, row.Max, row.Mean) == (1, 4, 0.0, 8.0, 4.0)
    assert row.Std == pytest.approx(np.std([0, 2, 6, 8])) and not row.DriftWarning
    assert (row.P25, row.P75) == (1.5, 6.5)


def test_quantiles_with_ties_count_values_not_rows(spark):
    """90 % of the rows are one value: the windows see the distinct values."""
    n = 20_000
    df = spark.range(n).select(
        (F.col("id") % 3).alias("g"),
        F.when(F.col("id") % 10 != 0, 1.0).otherwise(F.col("id") / 7.0 - 900).alias("v"),
    )
    pdf = df.toPandas()
    probs = {"lo": 0.02, "mid": 0.5, "hi": 0.995}
    got = exact_quantiles(df, "v", probs, by=["g"]).toPandas().set_index("g").sort_index()
    for name, p in probs.items():
        assert np.allclose(got[name], pdf.groupby("g").v.quantile(p), rtol=0, atol=0)
    # What a window task gets: a row per bucket, and per distinct value of an open bucket.
    buckets = df.groupBy("g", bucket(F.col("v")).alias("b")).count()
    assert buckets.count() <= pdf.groupby("g").v.nunique().sum() < 0.11 * n


def test_buckets_keep_the_order(spark):
    rng = np.random.default_rng(2)
    v = np.concatenate([rng.normal(size=2000) * 10.0 ** rng.integers(-300, 300, 2000), [0.0, 5e-324, -5e-324, np.inf, -np.inf, 1e308], 2.0 ** np.arange(-40, 40), np.nextafter(2.0 ** np.arange(-40, 40), 0)])
    rows = spark.createDataFrame([(float(x),) for x in v], "v double").select("v", bucket(F.col("v")).alias("b")).toPandas().sort_values("v")
    assert (np.diff(rows.b.to_numpy()) >= 0).all()


def test_building_quantiles_starts_no_job(spark):
    df = spark.range(100).select((F.col("id") % 2).alias("g"), F.col("id").cast("double").alias("v"))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("plan", "plan")
    exact_quantiles(df, "v", {"m": 0.5}, by=["g"])
    assert not tracker.getJobIdsForGroup("plan")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_correlations_of_all_pairs(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(1e6, 1.0, (500, 3))
    x[:, 1] += x[:, 0]
    x[::7, 2] = np.nan
    import pandas as pd

    pdf = pd.DataFrame(x, columns=list("abc"))
    got = stats.corr_long(spark.createDataFrame(pdf).repartition(4), list("abc")).toPandas()
    want = pdf.corr()
    for r in got.itertuples():
        assert r.Corr == pytest.approx(want.loc[r.FeatureA, r.FeatureB], abs=1e-7)
    assert len(got) == 9


def test_linear_model_keeps_both_coefficient_sets(spark, tmp_path):
    model = ml.LinearModel("Ridge Regression", ["x", "y"], [("c", ["a", "b"])], 1.5, [1.0, 2.0, 3.0, 4.0], [10.0, 20.0, 30.0, 40.0])
    back = ml.LinearModel.load(model.save(str(tmp_path / "m"), spark), spark)
    assert (back.numeric, back.levels, back.intercept) == (["x", "y"], [("c", ["a", "b"])], 1.5)
    assert back.coefs == model.coefs and back.std_coefs == model.std_coefs


def test_search_samples_are_seeded_and_different():
    a, b = ml.sampled_configs(ml.RF_SPACE, 15), ml.sampled_configs(ml.RF_SPACE, 15)
    assert a == b and len({tuple(c.values()) for c in a}) == 15
    assert ml.sampled_configs({"x": [1, 2]}, 5) in ([{"x": 1}, {"x": 2}], [{"x": 2}, {"x": 1}])


def test_imputation_fills_real_gaps(spark):
    rows = [(1.0, "a"), (3.0, None), (None, "a"), (8.0, "b")]
    out = ml.impute_for_scoring(spark.createDataFrame(rows, "x double, c string"), ["x"], ["c"]).collect()
    assert sorted((r.x, r.c) for r in out) == [(1.0, "a"), (3.0, "a"), (3.0, "a"), (8.0, "b")]


def test_metric_text(spark):
    rows = [("MAPE", 0.0471, "4.7%"), ("MeanLoadFactor", 12.3456, "1234.6%"), ("RMSE", 1234.56, "1,234.6 kg"), ("MeanTripTime", 7.0, "7.0 sec"), ("Other", 2.0, "2.0"), ("RMSE", None, "n/a")]
    df = spark.createDataFrame(rows, "m string, v double, want string").withColumn("got", tables.metric_text(F.col("m"), F.col("v")))
    assert all(r.got == r.want for r in df.collect())


def test_ranked_ties_go_by_name(spark):
    df = spark.createDataFrame([("b", 1.0), ("a", 1.0), ("c", 2.0)], "ScheduledRoute string, AnnualAvoidableCO2_t double").withColumns({"FlightCount": F.lit(1), "OpportunityScore": F.lit(0.0)})
    assert [(r.Rank, r.ScheduledRoute) for r in tables.emission_routes(df, 2).orderBy("Rank").collect()] == [(1, "c"), (2, "a")]


def test_paths_are_looked_up_whatever_their_scheme(spark, tmp_path):
    here = tmp_path / "x.csv"
    here.write_text("a\n")
    assert io.resolve_path("hdfs-like/none.csv", [f"file:{here}"], spark=spark) == f"file:{here}"
    assert io.resolve_path(None, [str(tmp_path / "no"), str(here)]) == str(here)
    with pytest.raises(io.MissingInput):
        io.resolve_path(None, [str(tmp_path / "no")], spark=spark)


def test_a_cluster_must_name_its_shared_folder():
    conf = types.SimpleNamespace(get=lambda *a: None)
    context = types.SimpleNamespace(master="spark://host:7077", getConf=lambda: conf, getCheckpointDir=lambda: None)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_dir(types.SimpleNamespace(conf=conf, sparkContext=context))
