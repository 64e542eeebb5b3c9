"""ML2/ML4 with a categorical of any number of levels (routes, tail numbers).

A ridge over standardised numerics and the one-hot levels of one column has a
diagonal one-hot block, so the level coefficients are eliminated by group sums
(Schur complement):

    g_l = (t_l - s_l . theta) / (n_l + alpha)

with n_l, s_l, t_l the count and the sums of z = [1, numerics] and of the label in
level l. What is left to solve has the size of the numerics, whatever the number of
levels; the levels stay a table.

* One pass over the rows gives the sums per (level, fold), one more aggregate per fold
  the Gram matrix of [z, label]. A hot level is one partial row per task and fold.
* Leaving a fold out is a sum over a level's other folds, so every fit is made from
  the same few rows per level; all penalties share them.
* The squared error of a held-out fold follows from its Gram matrix and its level
  sums, without another pass over the rows.
* The driver gets (folds + 1) x penalties x numerics x numerics numbers.

Semantics are those of scaler (population deviation, 0 counts as 1), one-hot encoder
(unseen and NULL levels: no effect) and ridge with a free intercept. Penalties must be
above 0. Rows need a label and all numerics.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..session import materialize
from .sizing import file_broadcast, with_scalars

#: The fit that leaves no fold out.
ALL = -1


@dataclass
class AbsorbedRidge:
    numeric: list
    category: str
    alpha: float
    intercept: float
    coefs: list
    effects: DataFrame  # (category, Effect), written
    cv_rmse: float
    search: list  # (alpha, cv rmse)

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds ``prediction``; the effects are broadcast if their files are small."""
        fit = F.lit(self.intercept)
        for c, w in zip(self.numeric, self.coefs):
            fit = fit + F.col(c).cast("double") * F.lit(w)
        effects = self.effects.select(F.col(self.category).alias("_level"), "Effect")
        out = df.join(file_broadcast(effects), F.col(self.category) == F.col("_level"), "left")
        return out.withColumn("prediction", fit + F.coalesce("Effect", F.lit(0.0))).drop("_level", "Effect")


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def _symmetric(row, k: int) -> np.ndarray:
    m = np.zeros((k, k))
    for i in range(k):
        for j in range(i, k):
            m[i, j] = m[j, i] = row[f"m{i}_{j}"] or 0.0
    return m


def _solve(gram, taken, alpha: float) -> np.ndarray:
    """theta over [1, centred numerics]: ``gram`` of [z, label] less what the levels take."""
    k = len(gram) - 1
    n = gram[0, 0]
    sd = np.sqrt(np.maximum(np.diag(gram)[:k] / n - (gram[0, :k] / n) ** 2, 0.0))
    sd[sd == 0] = 1.0
    d = 1 / sd
    penalty = np.diag([0.0] + [alpha] * (k - 1))
    left = gram - taken
    return d * np.linalg.lstsq(left[:k, :k] * np.outer(d, d) + penalty, d * left[:k, k], rcond=None)[0]


def absorbed_ridge_cv(train: DataFrame, numeric: list[str], category: str, alphas: list[float] | None = None,
                      label: str = "label", fold: str = "Fold") -> AbsorbedRidge:
    """Every penalty scored over the folds of ``train``; the best is fitted to all rows."""
    alphas = [float(a) for a in alphas or C.RIDGE_ALPHAS]
    if min(alphas) <= 0:
        raise ValueError("penalties must be above 0")
    spark = train.sparkSession
    k = len(numeric) + 1
    names = [f"z{i}" for i in range(k + 1)]  # [1, numerics, label]
    rows = train.select(F.col(category).alias("level"), F.col(fold).cast("int").alias("fold"),
                        *[F.col(c).cast("double").alias(f"v{i}") for i, c in enumerate([*numeric, label], 1)])
    # centred first, or large means would cancel the digits
    means = rows.agg(*[F.avg(f"v{i}").alias(f"c{i}") for i in range(1, k + 1)])
    centre = means.first()
    if centre[0] is None:
        raise ValueError("no rows to fit")
    z = with_scalars(rows, means).select(
        "level", "fold", F.lit(1.0).alias("z0"), *[(F.col(f"v{i}") - F.col(f"c{i}")).alias(f"z{i}") for i in range(1, k + 1)])

    products = [(i, j) for i in range(k + 1) for j in range(i, k + 1)]
    grams = {r.fold: _symmetric(r, k + 1) for r in z.groupBy("fold").agg(
        *[F.sum(F.col(f"z{i}") * F.col(f"z{j}")).alias(f"m{i}_{j}") for i, j in products]).collect()}
    folds = sorted(grams)
    total = sum(grams.values())

    # sums per level and fold, then per level and fit (all folds but one, or all)
    by_fold = materialize(z.where(F.col("level").isNotNull()).groupBy("level", "fold").agg(*[F.sum(c).alias(c) for c in names]), "levels")
    fits = F.filter(F.array(*[F.lit(f) for f in [ALL, *folds]]), lambda f: f != F.col("fold"))
    by_fit = materialize(by_fold.withColumn("fit", F.explode(fits)).groupBy("level", "fit").agg(*[F.sum(c).alias(c) for c in names]), "levels")
    taken = by_fit.withColumn("alpha", F.explode(F.array(*[F.lit(a) for a in alphas]))).groupBy("fit", "alpha").agg(
        *[F.sum(F.col(f"z{i}") * F.col(f"z{j}") / (F.col("z0") + F.col("alpha"))).alias(f"m{i}_{j}") for i, j in products])
    taken = {(r.fit, r.alpha): _symmetric(r, k + 1) for r in taken.collect()}
    none = np.zeros((k + 1, k + 1))
    theta = {(f, a): _solve(total - grams[f] if f != ALL else total, taken.get((f, a), none), a)
             for f in [ALL, *folds] for a in alphas if f == ALL or len(folds) > 1}

    # held-out error: the fold's quadratic form, corrected by its levels' effects
    solved = F.broadcast(spark.createDataFrame(  # folds x penalties rows
        [(f, a, [float(x) for x in t]) for (f, a), t in theta.items() if f != ALL], "fit int, alpha double, theta array<double>"))
    sums = F.array(*names[:k])
    effect = (F.col(f"z{k}") - _dot(sums, F.col("theta"))) / (F.col("z0") + F.col("alpha"))
    effects = by_fit.join(solved, "fit").select("level", F.col("fit").alias("fold"), "alpha", effect.alias("g"))
    held = by_fold.join(effects, ["level", "fold"]).join(solved.withColumnRenamed("fit", "fold"), ["fold", "alpha"])
    rest = F.col(f"z{k}") - _dot(sums, F.col("theta"))
    change = {(r.fold, r.alpha): r.change for r in held.groupBy("fold", "alpha").agg(
        F.sum(F.col("z0") * F.col("g") * F.col("g") - 2 * F.col("g") * rest).alias("change")).collect()}
    search = []
    for a in alphas:
        rmse = []
        for f in folds if len(folds) > 1 else []:
            beta = np.append(-theta[f, a], 1.0)
            sse = beta @ grams[f] @ beta + change.get((f, a), 0.0)
            rmse.append(np.sqrt(max(sse, 0.0) / grams[f][0, 0]))
        search.append((a, float(np.mean(rmse)) if rmse else float("nan")))
    alpha, cv = min(search, key=lambda t: (np.isnan(t[1]), t[1]))

    best = theta[ALL, alpha]
    effect = (F.col(f"z{k}") - _dot(sums, F.array(*[F.lit(float(x)) for x in best]))) / (F.col("z0") + F.lit(alpha))
    table = materialize(by_fit.where(F.col("fit") == ALL).select(F.col("level").alias(category), effect.alias("Effect")), "effects")
    coefs = [float(x) for x in best[1:]]
    intercept = float(centre[k - 1] + best[0] - sum(w * centre[i] for i, w in enumerate(coefs)))
    return AbsorbedRidge(list(numeric), category, alpha, intercept, coefs, table, cv, search)
