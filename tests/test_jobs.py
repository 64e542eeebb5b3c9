"""Stage sinks, row accounting, bootstrap intervals and violin densities."""

import gzip
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from burnlens.operators import resample
from burnlens.sources import accounting
from burnlens.sources.io import RAW_SCHEMA, MissingInput
from burnlens.sources.sinks import StageStore


def years(df):
    return {r.DepartureYear: (r.n, r.s) for r in df.groupBy("DepartureYear").agg(F.count("*").alias("n"), F.sum("x").alias("s")).collect()}


def frame(spark, rows):
    return spark.createDataFrame(rows, "DepartureYear int, x long")


def test_stage_switches_all_tables_together(spark, tmp_path):
    store = StageStore(spark, str(tmp_path))
    one, two = frame(spark, [(2020, 1), (2021, 2)]), spark.range(3)
    assert store.commit("s", {"flights": one, "extra": two}, {"flights": "DepartureYear"}) == 1
    broken = spark.range(5).select(F.raise_error(F.lit("disk full")).alias("id"))
    with pytest.raises(Exception, match="disk full"):
        store.commit("s", {"flights": frame(spark, [(2030, 9)]), "extra": broken}, {"flights": "DepartureYear"})
    # The table that was written before the failure is not to be seen.
    assert years(store.read("flights")) == {2020: (1, 1), 2021: (1, 2)}
    assert store.read("extra").count() == 3 and store.read("extra").columns == ["id"]
    assert store.commit("s", {"flights": frame(spark, [(2022, 5)]), "extra": spark.range(7)}, {"flights": "DepartureYear"}) > 1
    assert years(store.read("flights")) == {2022: (1, 5)} and store.read("extra").count() == 7
    assert sorted((r.Stage, r.Tables) for r in store.versions().collect()) == [("s", 2), ("s", 2)]


def test_partitions_are_updated_alone(spark, tmp_path):
    store = StageStore(spark, str(tmp_path))
    by = {"t": "DepartureYear"}
    store.commit("a", {"t": frame(spark, [(2020, 1), (2021, 2), (2021, 3)])}, by)
    old = store.read("t")
    store.commit("a", {"t": frame(spark, [(2021, 10), (2022, 20)])}, by, update=True)
    assert years(store.read("t")) == {2020: (1, 1), 2021: (1, 10), 2022: (1, 20)}
    assert years(old) == {2020: (1, 1), 2021: (2, 5)}  # a reader of the old version is not disturbed
    store.commit("a", {"t": frame(spark, [(2020, 7)])}, by, update=True)
    assert years(store.read("t")) == {2020: (1, 7), 2021: (1, 10), 2022: (1, 20)}
    store.commit("a", {"t": frame(spark, [(2025, 8)])}, by)
    assert years(store.read("t")) == {2025: (1, 8)}


def test_missing_tables_and_fallbacks(spark, tmp_path):
    store = StageStore(spark, str(tmp_path / "none"))
    with pytest.raises(MissingInput, match="run features first"):
        store.read("t", "features")
    assert store.read_or("t", lambda: spark.range(4)).count() == 4
    store.commit("a", {"t": spark.range(2)})
    assert store.read_or("t", lambda: spark.range(4)).count() == 2
    store.commit("a", {"p": frame(spark, [(2020, 1)]).where("false")}, {"p": "DepartureYear"})


def test_rows_are_accounted_for(spark, tmp_path):
    names = [f.name for f in RAW_SCHEMA.fields]
    good = {"FlightID": "f", "DepartureScheduled": "2024-01-02 03:04:05", "ArrivalScheduled": "2024-01-02 05:04:05", "Adults": "3", "Burnoff": "12.5"}
    rows = [
        good, good | {"Burnoff": "0"}, good | {"Burnoff": ""}, good | {"Burnoff": "-4"}, good | {"Adults": "many"}, good | {"Adults": "many", "DepartureScheduled": "soon"},
        good | {"DepartureScheduled": "soon"}, good | {"ArrivalScheduled": "2024-13-45 99:00:00", "Burnoff": "0"}, good | {"DepartureScheduled": ""},
    ]
    path = tmp_path / "fact.csv"
    path.write_text("\n".join([",".join(names), *(",".join(r.get(n, "") for n in names) for r in rows)]) + "\n")
    accepted, rejected, counts = accounting.read_counted(spark, str(path))
    assert counts == {"read": 9, "accepted": 2, accounting.MALFORMED: 2, accounting.BAD_TIME: 2, accounting.BAD_TARGET: 3}
    assert accepted.schema["DepartureScheduled"].dataType.typeName() == "timestamp_ntz" and accepted.columns == names
    assert accepted.count() == 2 and {r.Reason: r["count"] for r in rejected.groupBy("Reason").count().collect()} == {k: v for k, v in counts.items() if k not in ("read", "accepted")}
    assert all("many" in r["_raw"] for r in rejected.where(F.col("Reason") == accounting.MALFORMED).collect())
    # The scoring variant refuses no row for its target.
    _, _, counts = accounting.read_counted(spark, str(path), target=None)
    assert counts["accepted"] == 5 and counts[accounting.BAD_TARGET] == 0
    (tmp_path / "empty.csv").write_text(",".join(names) + "\n")
    assert accounting.read_counted(spark, str(tmp_path / "empty.csv"))[2]["read"] == 0


def test_accounted_rows_are_compact(spark, tmp_path, monkeypatch):
    """The text is compressed in files of bounded rows, the accounted table packed; every row is counted."""
    written = []
    monkeypatch.setattr(accounting, "remove_at_exit", lambda spark, path: written.append(path))
    monkeypatch.setattr(accounting, "TEXT_FILE_ROWS", 700, raising=False)
    k = F.col("id")
    made = {
        "FlightID": F.concat(F.lit('f,"'), k), "AircraftTypeGroup": F.when(k % 5 == 0, F.lit(None)).otherwise(F.lit("NG")), "DepartureScheduled": F.when(k % 10 == 1, F.lit("soon")).otherwise(F.lit("2024-01-02 03:04:05")),
        "Adults": F.when(k % 10 == 2, F.lit("many")).otherwise(F.lit("3")), "PlannedTOW": 41000 + k / 7, "Burnoff": F.when(k % 10 == 3, F.lit(0.0)).otherwise(k + 0.1),
    }
    rows = spark.range(2000, numPartitions=2).select(*[made.get(f.name, F.lit(None)).cast("string").alias(f.name) for f in RAW_SCHEMA.fields])
    fact = rows.unionAll(rows)  # every row comes twice
    accounting.write_text(fact, str(tmp_path / "fact"))
    parts = [p for p in (tmp_path / "fact").iterdir() if p.name.startswith("part-")]
    assert len(parts) == 8 and all(len(gzip.decompress(p.read_bytes()).splitlines()) <= 701 for p in parts)
    fact.write.option("header", True).csv(str(tmp_path / "plain"))
    plain = sum(p.stat().st_size for p in (tmp_path / "plain").iterdir() if p.name.startswith("part-"))
    assert sum(p.stat().st_size for p in parts) < plain / 3
    accepted, rejected, counts = accounting.read_counted(spark, str(tmp_path / "fact"))
    assert counts == {"read": 4000, "accepted": 2800, accounting.MALFORMED: 400, accounting.BAD_TIME: 400, accounting.BAD_TARGET: 400}
    assert accepted.count() == 2800 and accepted.select("FlightID").distinct().count() == 1400 and rejected.count() == 1200
    assert accepted.where("AircraftTypeGroup IS NULL").count() == 800
    assert all(".zstd" in f for f in accepted.inputFiles()) and len(written) == 1


def test_weights_are_poisson(spark):
    steps = resample.poisson_steps()
    share = np.diff([0, *steps, resample.PRIME]) / resample.PRIME
    assert np.allclose(share[:6], [math.exp(-1) / math.factorial(k) for k in range(6)], atol=1e-6)
    df = spark.range(3000).select(F.lit("g").alias("g"), F.col("id").alias("key"), F.lit(1.0).alias("x"))
    h1, h2 = resample.key_hashes("key")
    u = [((a * ((resample.FIRST_MULTIPLIER + b * resample.NEXT_MULTIPLIER) % resample.PRIME) + c) % resample.PRIME) for a, c in df.select(h1, h2).collect() for b in range(20)]
    weights = np.searchsorted(steps, u, "right")
    assert abs(weights.mean() - 1) < 0.02 and abs(weights.var() - 1) < 0.04


def test_bootstrap_interval_covers_the_mean(spark):
    """Of 60 groups of normal values, about 95 % of the intervals hold the true mean; none depends on partitioning."""
    rng = np.random.default_rng(11)
    rows = [(f"g{g}", g * 1000 + k, float(rng.normal(5, 2))) for g in range(60) for k in range(150)]
    df = spark.createDataFrame([*rows, (None, -1, 3.0), ("none", -2, None)], "g string, key long, x double")
    got = {r.g: r for r in resample.bootstrap_interval(df, "x", "g", "key").collect()}
    inside = [got[f"g{g}"].CILow <= 5 <= got[f"g{g}"].CIHigh for g in range(60)]
    assert sum(inside) >= 52
    width = np.mean([got[f"g{g}"].CIHigh - got[f"g{g}"].CILow for g in range(60)])
    assert abs(width - 2 * 1.96 * 2 / math.sqrt(150)) < 0.08
    assert got["none"].CILow is None and got["none"].Rows == 0 and None not in got
    again = {r.g: r for r in resample.bootstrap_interval(df.repartition(13), "x", "g", "key").collect()}
    assert all(np.isclose(again[g].CILow, r.CILow) for g, r in got.items() if r.CILow is not None)


def test_violin_against_a_direct_sum(spark):
    rng = np.random.default_rng(3)
    groups = {"a": rng.normal(0, 1, 400), "b": np.concatenate([rng.normal(-3, 0.5, 200), rng.normal(4, 1, 300)]), "flat": np.ones(5), "one": np.array([2.0])}
    df = spark.createDataFrame([(g, float(x)) for g, v in groups.items() for x in v] + [("a", None), (None, 1.0)], "g string, x double").repartition(5)
    got = resample.violin(df, "x", "g").toPandas()
    assert set(got.g) == {"a", "b"}
    for g, part in got.sort_values("Point").groupby("g"):
        v = groups[g]
        bw = len(v) ** -0.2 * v.std(ddof=1)
        grid = np.linspace(v.min() - 2 * bw, v.max() + 2 * bw, 100)
        direct = np.exp(-0.5 * ((grid[:, None] - v) / bw) ** 2).sum(1) / (len(v) * bw * math.sqrt(2 * math.pi))
        assert np.allclose(part.X, grid)
        assert np.abs(part.Density - direct).max() < 0.01 * direct.max()
        assert abs(np.trapezoid(part.Density, part.X) - 1) < 0.05
