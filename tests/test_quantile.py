"""Exact quantiles equal pandas' linear interpolation, including a hot
group, tiny groups, duplicates and NULLs."""

import numpy as np
import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st

from burnlens.functions.quantile import exact_quantiles


def _pandas(pdf, by, probs):
    g = pdf.dropna(subset=["v"]).groupby(by)["v"]
    return {k: {n: g.get_group(k).quantile(p) for n, p in probs.items()} for k in g.groups}


def test_matches_pandas_with_hot_group(spark):
    rng = np.random.default_rng(7)
    keys = ["hot"] * 30000 + [str(x) for x in rng.choice(["a", "b", "c"], 3000)] + ["one", "two", "two"]
    vals = [float(x) for x in rng.normal(0, 100, 30000)] + [float(x) for x in rng.integers(0, 5, 3000)] + [1.5, 2.0, 4.0]
    vals[5] = None
    pdf = pd.DataFrame({"k": keys, "v": vals})
    probs = {"med": 0.5, "p90": 0.9, "p995": 0.995, "p0": 0.0, "p1": 1.0}
    out = exact_quantiles(spark.createDataFrame(pdf), "v", probs, by=["k"]).collect()
    want = _pandas(pdf, "k", probs)
    assert len(out) == len(want)
    for r in out:
        for n in probs:
            assert np.isclose(r[n], want[r["k"]][n], rtol=1e-12, atol=1e-9), (r["k"], n)


def test_global_quantile(spark):
    rng = np.random.default_rng(3)
    v = rng.exponential(50, 20000)
    df = spark.createDataFrame(pd.DataFrame({"v": v}))
    r = exact_quantiles(df, "v", {"q": 0.995, "m": 0.5}).first()
    assert np.isclose(r["q"], np.quantile(v, 0.995)) and np.isclose(r["m"], np.median(v))


@settings(max_examples=15, deadline=None)
@given(st.lists(st.floats(-1e6, 1e6, allow_nan=False), min_size=1, max_size=40), st.floats(0, 1))
def test_property_small_groups(spark, xs, p):
    df = spark.createDataFrame(pd.DataFrame({"g": 1, "v": xs}))
    got = exact_quantiles(df, "v", {"q": p}, by=["g"]).first()["q"]
    assert np.isclose(got, pd.Series(xs).quantile(p), rtol=1e-9, atol=1e-6)
