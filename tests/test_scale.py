"""What the stages, the star join and the grouped quantiles write and shuffle: each grows
with the input, and no more."""

import glob

import numpy as np
import pandas as pd
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from burnlens import config as C
from burnlens.functions import quantile
from burnlens.functions import scalar as S
from burnlens.operators import predict
from burnlens.plans import catalog, stages
from burnlens.session import checkpoint_dir, materialize
from burnlens.sources import bind, sinks
from tests.conftest import SF_SMALL


def written(spark, name):
    return {f: pq.read_schema(f).names for f in glob.glob(f"{checkpoint_dir(spark)}/burnlens/{name}-*/*.parquet")}


def test_stages_write_only_what_a_row_cannot_give_again(spark):
    before = {n: set(written(spark, n)) for n in ("engineered", "zscored", "scored")}
    flights = stages.scored(spark, SF_SMALL, reuse=False)
    new = {n: [cols for f, cols in written(spark, n).items() if f not in before[n]] for n in before}
    assert not new["zscored"] and new["engineered"] and new["scored"]
    for cols in new["engineered"] + new["scored"]:
        assert not {"RowKey", "PlannedZeroFuelWeight", "AvoidableCO2_kg", "ResidualZ_segment", "LikelyIssueClass"} & set(cols)
    assert {"RowKey", "ResidualZ_segment", "LikelyIssueClass", "AnnualisedAvoidableCost_eur"} <= set(flights.columns)


def test_engineered_view_equals_its_plan(spark):
    view, plan = stages.engineered(spark, SF_SMALL, reuse=False), stages.engineered_plan(spark, SF_SMALL)
    assert sorted(view.columns) == sorted(plan.columns)
    assert dict(view.dtypes) == dict(plan.dtypes)
    cols = sorted(plan.columns)
    assert view.select(cols).exceptAll(plan.select(cols)).isEmpty() and plan.select(cols).exceptAll(view.select(cols)).isEmpty()


def test_star_join_is_cut_by_the_bytes_of_lineitem(spark, monkeypatch):
    want = bind.raw_fact(spark, SF_SMALL)
    monkeypatch.setattr(bind, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(bind, "JOIN_BYTES", 1000)
    got = bind.raw_fact(spark, SF_SMALL)
    size = bind.scan_bytes(bind.table(spark, SF_SMALL, "lineitem"), None)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert f"RepartitionByExpression [l_orderkey" in plan and f", {-(-size // 1000)}" in plan
    assert got.count() == want.count() and got.exceptAll(want).isEmpty()


def test_many_groups_get_coarse_buckets(spark):
    df = spark.range(2000).select((F.col("id") + 1024).cast("double").alias("v"))
    cut = df.select(quantile.bucket(F.col("v"), quantile.COARSE_BUCKETS).alias("b"), "v")
    assert cut.select("b").distinct().count() <= 2 * quantile.COARSE_BUCKETS
    assert [r.b for r in cut.orderBy("v").collect()] == sorted(r.b for r in cut.collect())


@pytest.mark.parametrize("rows", [0, 50, 10**9])
def test_refined_buckets_give_the_same_quantiles(spark, monkeypatch, rows):
    monkeypatch.setattr(quantile, "OPEN_ROWS", rows)
    rng = np.random.default_rng(8)
    pdf = pd.DataFrame({"g": rng.choice(["a", "b", None], 4000, p=[0.8, 0.15, 0.05]), "v": rng.normal(3, 10, 4000)})
    pdf.loc[:200, "v"] = 7.5
    probs = {"a0": 0.0, "q": 0.1, "m": 0.5, "p": 0.995, "z1": 1.0}
    df = spark.createDataFrame([(g, float(v)) for g, v in pdf.itertuples(index=False)], "g string, v double")
    got = {r.g: r for r in quantile.exact_quantiles(df, "v", probs, by=["g"], write=True).collect()}
    assert len(got) == 3
    for g, rows_ in pdf.assign(g=pdf.g.fillna("-")).groupby("g"):
        for name, p in probs.items():
            assert got[None if g == "-" else g][name] == pytest.approx(rows_.v.quantile(p), rel=1e-12)


def test_benchmark_is_one_pass_with_both_means(spark):
    rows = [(k, t, b) for k in range(60) for t, b in (("NG", 10.0 + k), ("Max", None if k % 2 else 3.0 * k), (None, 1.0))]
    only_validation = [r.k for r in predict.hash_split(spark.range(400).toDF("OrderKey")).where("IsValidation").select(F.col("OrderKey").alias("k")).limit(3).collect()]
    rows += [(k, "rare", 5.0) for k in only_validation]
    eng = spark.createDataFrame(rows, f"OrderKey long, AircraftTypeGroup string, {C.TARGET} double")
    split = predict.hash_split(eng)
    train = {r[0]: r[1] for r in predict.group_mean_model(split.where(~F.col("IsValidation"))).collect()}
    every = {r[0]: r[1] for r in predict.group_mean_model(split).collect()}
    out = predict.with_benchmark(eng)
    # one written table of means (two before)
    assert str(out._jdf.queryExecution().optimizedPlan()).count("parquet") == 1
    assert out.count() == len(rows)
    for r in out.collect():
        assert r.PredictedBurn_kg == train.get(r.AircraftTypeGroup) and r.BaselinePred_kg == every.get(r.AircraftTypeGroup)
    assert "rare" in every and "rare" not in train


def test_rounding_computes_a_power_once(spark):
    xs = [0.0, -0.0, 1.0, -1.5, 123456789.123, 9.999999995e-7, 1e300, -1e-300, 5e-324, float("inf"), float("-inf"), float("nan"), None]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    out = catalog.finalize(df, {"x"})
    assert [repr(r.x) for r in out.collect()] == [repr(r.x) for r in df.select(S.sig_round("x").alias("x")).collect()]
    assert str(out._jdf.queryExecution().optimizedPlan()).upper().count("LOG10(") == 1


def test_partitioned_tables_are_written_without_a_sort(spark, tmp_path, monkeypatch):
    seen, setting = [], "spark.sql.maxConcurrentOutputFileWriters"
    df = spark.range(100).select((F.col("id") % 5).cast("int").alias("Year"), "id")
    before, partitions = spark.conf.get(setting), sinks.StageStore._partitions
    write = sinks.StageStore._write_partitioned
    monkeypatch.setattr(sinks.StageStore, "_write_partitioned", lambda self, *a: (write(self, *a), seen.append(a[1])))
    store = sinks.StageStore(spark, str(tmp_path))
    store.commit("s", {"t": df}, {"t": "Year"})
    assert seen == ["Year"] and sinks.OPEN_FILES > 1 and spark.conf.get(setting) == before
    assert store.read("t").groupBy("Year").count().count() == 5 and len(partitions(store, f"{tmp_path}/t/Version=1")) == 5


def test_scoring_rows_keep_every_row_of_the_validation_orders(spark):
    raw = predict.hash_split(bind.raw_fact(spark, SF_SMALL)).where("IsValidation")
    rows = stages.scoring_rows(spark, SF_SMALL)
    assert C.TARGET not in rows.columns and rows.count() == raw.count()
    assert rows.select("RowKey", "ScheduledRoute").exceptAll(raw.select("RowKey", "ScheduledRoute")).isEmpty()
    assert all("RowKey" not in cols for cols in written(spark, "scoring").values())


def test_written_tables_are_packed_tightly(spark, tmp_path):
    df = spark.range(50_000).select((F.col("id") % 3).cast("int").alias("Year"), (F.xxhash64("id") % 100000 / 7).alias("x"))
    store = sinks.StageStore(spark, str(tmp_path))
    store.commit("s", {"parts": df, "whole": df}, {"parts": "Year"})
    materialize(df, "packed")
    files = glob.glob(f"{tmp_path}/parts/*/*/*.parquet") + glob.glob(f"{tmp_path}/whole/*/*.parquet") + glob.glob(f"{checkpoint_dir(spark)}/burnlens/packed-*/*.parquet")
    codecs = {pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in files}
    assert codecs == {"ZSTD"}
