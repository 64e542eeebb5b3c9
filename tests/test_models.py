"""Row keys and numbers, group-mean and leave-fold-out models, the registry of saved models."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from burnlens.operators import ml, models, rows
from burnlens.sources import io


@pytest.fixture(scope="module")
def flights(spark):
    rng = np.random.default_rng(7)
    n = 500
    pdf = pd.DataFrame(
        {
            "RowKey": [f"k{k}" for k in range(n)],
            "ScheduledRoute": rng.choice(["A-B", "B-C", "C-A", None], n, p=[0.6, 0.2, 0.15, 0.05]),
            "AircraftTypeGroup": rng.choice(["NG", "Max", None], n, p=[0.5, 0.45, 0.05]),
            "Fold": rng.integers(0, 5, n),
            "Burnoff": np.round(rng.normal(4000, 500, n), 3),
        }
    )
    pdf.loc[0, ["ScheduledRoute", "AircraftTypeGroup"]] = ["X-Y", "Solo"]  # a group of one row
    return pdf, spark.createDataFrame(pdf).repartition(7)


LEVELS = [["ScheduledRoute", "AircraftTypeGroup"], ["AircraftTypeGroup"], []]


@pytest.mark.parametrize("parts", [1, 3, 40])
def test_row_numbers_are_dense(spark, parts):
    df = spark.range(1000).repartition(parts).where("id % 7 <> 0")
    got = sorted(r.RowNumber for r in rows.number_rows(df, start=5).collect())
    assert got == list(range(5, 5 + df.count()))
    assert rows.number_rows(df.where("id < 0")).count() == 0


def test_keys_are_checked(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a"), (1, "a"), (None, "c")], "x int, y string")
    assert tuple(rows.key_report(df, "x", "y").first()) == (5, 4, 1, 1)
    with pytest.raises(rows.RepeatedKey):
        rows.require_unique(df, "x", "y")
    unique = df.where("y = 'b' OR x = 2")
    assert rows.require_unique(unique, "x") is unique
    assert tuple(rows.key_report(df.where("false"), "x").first()) == (0, 0, 0, 0)


def test_group_mean_falls_back(spark, flights):
    pdf, df = flights
    train = df.where("Fold > 0")
    fitted = models.GroupMean.fit(train, LEVELS)
    unseen = spark.createDataFrame([("A-B", "NG"), ("A-B", "Never"), (None, "Max"), (None, None)], "ScheduledRoute string, AircraftTypeGroup string")
    got = [r.prediction for r in fitted.transform(unseen.coalesce(1)).collect()]
    t = pdf[pdf.Fold > 0]
    want = [
        t[(t.ScheduledRoute == "A-B") & (t.AircraftTypeGroup == "NG")].Burnoff.mean(),
        t.Burnoff.mean(),
        t[t.AircraftTypeGroup == "Max"].Burnoff.mean(),
        t.Burnoff.mean(),
    ]
    assert np.allclose(sorted(got), sorted(want))


def test_leave_fold_out_never_sees_its_fold(flights):
    pdf, df = flights
    got = {r.RowKey: r.p for r in models.leave_fold_out(df, LEVELS, "p").collect()}
    assert len(got) == len(pdf)
    for r in pdf.itertuples():
        other = pdf[pdf.Fold != r.Fold]
        fine = other[(other.ScheduledRoute == r.ScheduledRoute) & (other.AircraftTypeGroup == r.AircraftTypeGroup)]
        coarse = other[other.AircraftTypeGroup == r.AircraftTypeGroup]
        want = next(x for x in (fine, coarse, other) if len(x)).Burnoff.mean()
        assert np.isclose(got[r.RowKey], want)


def test_registry_skips_broken_models(spark, flights, tmp_path):
    pdf, df = flights
    registry = models.Registry(spark, str(tmp_path / "models"))
    fine, coarse = models.GroupMean.fit(df, LEVELS), models.GroupMean.fit(df, [[]])
    line = ml.LinearModel("Line", ["Fold"], [("AircraftTypeGroup", ["NG"])], 1.5, [2.0, -9.0], [0.1, 0.2])
    registry.add("Fine", fine, fine.features(), df.schema, 1.0)
    registry.add("Line", line, ["Fold", "AircraftTypeGroup"], df.schema, 2.0)
    registry.add("Coarse", coarse, [], df.schema, 3.0)
    assert registry.first_usable(df.schema).Model == "Fine"
    assert registry.first_usable(df.schema, preferred="Coarse").Model == "Coarse"
    # Other types or no such column: the next of the ranking that fits.
    assert registry.first_usable(df.drop("ScheduledRoute").schema).Model == "Line"
    other = df.drop("ScheduledRoute").withColumn("Fold", F.col("Fold").cast("string"))
    assert registry.first_usable(other.schema).Model == "Coarse"
    scored = registry.score(df.drop("ScheduledRoute"), preferred="Line")
    want = {r.RowKey: 1.5 + 2 * r.Fold - (9 if r.AircraftTypeGroup == "NG" else 0) for r in pdf.itertuples()}
    sent = {r.RowKey: r for r in models.submitted(scored, "RowKey").collect()}
    assert all(sent[k].Burnoff == max(v, 0) and sent[k].WasNegative == (v < 0) and sent[k].Model == "Line" for k, v in want.items())
    # A later row of a name counts; files that are gone are told from the listing.
    registry.add("Coarse", coarse, [], df.schema, 0.5)
    assert registry.first_usable(df.schema).Model == "Coarse" and len(registry.rows()) == 3
    lost = registry.rows()[0].asDict() | {"Path": str(tmp_path / "nowhere"), "Saved": 1 << 62}
    spark.createDataFrame([tuple(lost.values())], models.MANIFEST).write.mode("append").parquet(f"{registry.folder}/manifest")
    assert registry.first_usable(df.schema).Model == "Fine"
    with pytest.raises(ValueError):
        registry.add("Needs more", fine, ["NoSuchColumn"], df.schema, 1.0)


def test_no_usable_model(spark, flights, tmp_path):
    _, df = flights
    registry = models.Registry(spark, str(tmp_path / "m"))
    fine = models.GroupMean.fit(df, LEVELS)
    registry.add("Fine", fine, fine.features(), df.schema, 1.0)
    with pytest.raises(models.NoUsableModel, match="other features"):
        registry.score(df.drop("AircraftTypeGroup"))


def test_submission_rounds_half_to_even(spark):
    df = spark.createDataFrame([(k, v) for k, v in enumerate([0.125, 0.375, -3.0, 2.0, 1e-9])], "k int, prediction double")
    assert [r.Burnoff for r in io.submission(df, "k").orderBy("k").collect()] == [0.12, 0.38, 0.0, 2.0, 0.0]


def test_primary_model(spark):
    board = spark.createDataFrame([("A", 2.0), ("B", 1.0), ("GBT", 3.0)], "Model string, RMSE double")
    assert [r.Model for r in models.with_primary(board).where("Primary").collect()] == ["B"]
    assert [r.Model for r in models.with_primary(board, "GBT").where("Primary").collect()] == ["GBT"]
    assert [r.Model for r in models.with_primary(board, "None").where("Primary").collect()] == ["B"]


def test_consensus_is_over_models(spark):
    rows = [("A", "x", 1), ("A", "y", 2), ("B", "y", 1), ("B", "z", 2), ("C", "y", 3), ("C", "x", 1), ("C", "w", 2)]
    df = spark.createDataFrame(rows, "Model string, Feature string, Rank int")
    got = [(r.Position, r.Feature, r.Models) for r in ml.importance_consensus(df).orderBy("Position").collect()]
    assert got == [(1, "y", 3), (2, "x", 2), (3, "w", 1)]


def test_distance_error_leaves_out_the_largest(spark):
    from burnlens.operators import tables

    rng = np.random.default_rng(1)
    km = rng.uniform(100, 3000, 500)
    err = 0.5 * km + rng.normal(0, 10, 500)
    err[:4] = 1e6
    pdf = pd.DataFrame({"AbsError": err, "RouteDistanceKm": km})
    got = tables.distance_error(spark.createDataFrame(pdf).repartition(4)).first()
    kept = pdf[pdf.AbsError <= pdf.AbsError.quantile(0.99)]
    assert got.Rows == len(kept) and np.isclose(got.SlopePerKm, np.polyfit(kept.RouteDistanceKm, kept.AbsError, 1)[0])
    short = kept[kept.RouteDistanceKm <= kept.RouteDistanceKm.quantile(0.25)].AbsError.mean()
    long = kept[kept.RouteDistanceKm >= kept.RouteDistanceKm.quantile(0.75)].AbsError.mean()
    assert np.isclose(got.LongMinusShort, long - short)
