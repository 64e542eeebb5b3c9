"""Benchmark and segment are written per combination of their keys, not per row."""

import datetime
import glob
import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from burnlens import config as C
from burnlens.operators import predict, segments
from burnlens.plans import stages
from burnlens.session import checkpoint_dir
from burnlens.sources import bind


@pytest.fixture(scope="module")
def eng(spark):
    rng = random.Random(11)
    rows = []
    for _ in range(600):
        route = rng.choices(["A-B", "B-A", "A-C", "C-A", None], [50, 30, 10, 5, 5])[0]
        kind = rng.choices(["NG", "Max", "rare", None], [50, 40, 2, 8])[0]
        season = rng.choices(["Spring", "Winter", None], [60, 35, 5])[0]
        price = round(rng.uniform(1500, 90000), 2)
        row = [rng.randint(1, 150), rng.randint(1, 90), rng.randint(1, 9), rng.randint(1, 7), float(rng.randint(1, 50)), price, 0.05, 0.02, "N"]
        row += [datetime.datetime(1996, 5, 1), 20, 1000.0, "BUILDING", route, kind, rng.choice([3, 6, 11, 18]), 5, 1996, 2, season]
        rows.append((*row, route and route[0], route and route[-1], False, 900.0))
    rows += rows[:5]  # repeated rows stay
    types = (
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
        "l_returnflag string, l_shipdate timestamp_ntz, p_size int, p_retailprice double, c_mktsegment string, ScheduledRoute string, AircraftTypeGroup string, "
        "DepartureHour int, DepartureMonth int, DepartureYear int, DepartureDayOfWeek int, Season string, Origin string, Destination string, "
        "DistanceImputed boolean, RouteDistanceKm double"
    )
    return stages.engineered_columns(spark.createDataFrame(rows, types).coalesce(1), bind.SOURCE_COLUMNS)


def shown(df):
    exact = ["RowKey", "IsValidation", "Fold", "SegmentBasis", "PredictedBurn_kg", "BaselinePred_kg"]
    means = ["_gmean", "_gstd", "ResidualMean_segment", "ResidualStd_segment"]
    return sorted(map(str, (tuple(r) for r in df.select(*exact, *[F.round(c, 6) for c in means]).collect())))


@pytest.mark.parametrize("most", [1 << 26, 0])
def test_scores_of_keys_are_those_of_rows(spark, eng, monkeypatch, most):
    monkeypatch.setattr(stages, "COMBINATION_BYTES", most)
    rules = C.AnomalyRules()
    whole = segments.segment_basis(stages.valued_plan(predict.with_benchmark(eng)), rules.z_specs, min_size=rules.min_segment)
    before = set(glob.glob(f"{checkpoint_dir(spark)}/burnlens/scored-*"))
    got = stages.engineered_columns(stages.with_scores(eng, rules), stages.WRITTEN_SCORES)
    assert shown(got) == shown(whole)
    assert got.where("SegmentBasis = 'Global'").count() < got.where("SegmentBasis <> 'Global'").count()
    new = set(glob.glob(f"{checkpoint_dir(spark)}/burnlens/scored-*")) - before
    sizes = sorted(sum(pq.read_metadata(f).num_rows for f in glob.glob(f"{d}/*.parquet")) for d in new)
    combinations = eng.select(*stages.score_keys(rules)[:2], "Origin", "Season", "DepartureHour").distinct().count()
    # beyond the bound the rows are written with their scores
    assert sizes == ([combinations] if most else [combinations, eng.count()])


def test_departure_time_is_not_written():
    assert "DepartureScheduled" not in stages.WRITTEN_FEATURES  # it follows from ship date and part
