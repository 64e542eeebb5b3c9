"""Ridge with its levels eliminated by group sums: equal to the dense closed form
for few levels, and to known effects for 100,000."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from burnlens.operators import absorbed, ml


def _frame(n=800, seed=3):
    rng = np.random.default_rng(seed)
    pdf = pd.DataFrame({
        "x1": rng.normal(1e4, 3, n), "x2": rng.uniform(0, 1, n), "x3": np.full(n, 2.0),
        "c": rng.choice(["a", "b", "c", "only"], n, p=[0.5, 0.3, 0.199, 0.001]), "Fold": rng.integers(0, 5, n),
    })
    pdf["label"] = 3 * pdf.x1 - 7 * pdf.x2 + (pdf.c == "b") * 4 + rng.normal(0, 1, n)
    return pdf


@pytest.mark.parametrize("nulls", [False, True])
def test_equals_the_dense_closed_form(spark, nulls):
    pdf = _frame()
    if nulls:
        pdf.loc[::9, "c"] = None
    df = spark.createDataFrame(pdf).repartition(4)
    num, alphas = ["x1", "x2", "x3"], [0.01, 1.0, 100.0]
    got = absorbed.absorbed_ridge_cv(df, num, "c", alphas)
    want = ml.ridge_closed_form_cv(df, alphas, num, ["c"])
    assert [a for a, _ in got.search] == [p["alpha"] for p, _ in want.search]
    assert np.allclose([r for _, r in got.search], [r for _, r in want.search], rtol=1e-5)
    assert got.alpha == min(want.search, key=lambda t: t[1])[0]["alpha"]
    a = got.transform(df).groupBy().agg(F.sum("prediction"), F.max("prediction")).first()
    b = want.model.transform(df.fillna("-", ["c"])).groupBy().agg(F.sum("prediction"), F.max("prediction")).first()
    assert tuple(a) == pytest.approx(tuple(b), rel=1e-8)


def test_a_hundred_thousand_levels(spark):
    n, levels = 300_000, 100_000
    df = spark.range(n).select(
        (F.col("id") % levels).alias("c"), (F.pmod(F.xxhash64("id"), F.lit(1000)) / 1000).alias("x"),
        F.pmod(F.xxhash64("id", F.lit(1)), F.lit(5)).cast("int").alias("Fold"),
    ).withColumn("label", 2 * F.col("x") + F.col("c") / levels)
    got = absorbed.absorbed_ridge_cv(df, ["x"], "c", [1e-6, 1.0])
    assert got.alpha == 1e-6 and got.effects.count() == levels
    assert got.coefs[0] == pytest.approx(2.0, abs=1e-4)
    assert got.transform(df).agg(F.max(F.abs(F.col("prediction") - F.col("label")))).first()[0] < 1e-3


def test_unseen_levels_have_no_effect_and_no_rows_are_an_error(spark):
    df = spark.createDataFrame(_frame(200))
    fit = absorbed.absorbed_ridge_cv(df, ["x2"], "c", [1.0])
    new = spark.createDataFrame([(0.5, "new"), (0.5, None)], "x2 double, c string")
    assert [r.prediction for r in fit.transform(new).collect()] == pytest.approx([fit.intercept + 0.5 * fit.coefs[0]] * 2)
    with pytest.raises(ValueError, match="no rows"):
        absorbed.absorbed_ridge_cv(df.limit(0), ["x2"], "c", [1.0])
    with pytest.raises(ValueError, match="above 0"):
        absorbed.absorbed_ridge_cv(df, ["x2"], "c", [0.0])
