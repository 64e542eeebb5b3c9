"""Statistics on tables.

All moments are algebraic aggregates (sums, co-moments) merged across tasks;
only k x k matrices (k = number of features) ever reach the driver.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.quantile import exact_quantiles
from .sizing import with_scalars


def corr_long(df: DataFrame, cols: list[str]) -> DataFrame:
    """L1: Pearson r for every ordered pair, pairwise-complete rows (NULLs and
    NaN skipped per pair, like pandas; NaN where a column doesn't vary or no row
    has both); long (FeatureA, FeatureB, Corr).

    A generator deals every row to its pairs inside the scan's stage, and the
    built-in ``corr`` (centred co-moments, merged across tasks) adds them up: one
    pass, and one row per pair and task is shuffled."""
    # NaN counts as missing, as in pandas
    x = [F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c in cols]
    rows = df.select(*[e.alias(f"_x{i}") for i, e in enumerate(x)])
    pairs = [(i, j) for i in range(len(cols)) for j in range(i + 1, len(cols))]
    out = df.sparkSession.createDataFrame([(c, c, 1.0) for c in cols], "FeatureA string, FeatureB string, Corr double")
    if not pairs:
        return out
    dealt = rows.select(F.inline(F.array(*[
        F.struct(F.lit(p).alias("_p"), F.col(f"_x{i}").alias("_a"), F.col(f"_x{j}").alias("_b")) for p, (i, j) in enumerate(pairs)
    ])))
    r = dealt.groupBy("_p").agg(F.corr("_a", "_b").alias("_r"))
    named = df.sparkSession.createDataFrame(
        [(p, cols[a], cols[b]) for p, (i, j) in enumerate(pairs) for a, b in ((i, j), (j, i))], "_p int, FeatureA string, FeatureB string")
    both = named.join(F.broadcast(r), "_p", "left")  # a row per pair at most
    return out.unionByName(both.select("FeatureA", "FeatureB", F.coalesce("_r", F.lit(float("nan"))).alias("Corr")))


def strongest_pairs(corr: DataFrame, target: str) -> DataFrame:
    """L2: the strongest correlate of ``target`` and the strongest pair of the
    upper triangle (by |r|, name tie-break)."""
    off = corr.where(F.col("FeatureA") != F.col("FeatureB"))
    best_t = off.where(F.col("FeatureA") == target).orderBy(F.desc(F.abs("Corr")), "FeatureB").limit(1).select(
        F.lit("target").alias("Kind"), "FeatureA", "FeatureB", "Corr"
    )
    best_p = off.where(F.col("FeatureA") < F.col("FeatureB")).orderBy(
        F.desc(F.abs("Corr")), "FeatureA", "FeatureB"
    ).limit(1).select(F.lit("pair").alias("Kind"), "FeatureA", "FeatureB", "Corr")
    return best_t.unionByName(best_p)


def gram_matrix(df: DataFrame, cols: list[str]) -> tuple[np.ndarray, int]:
    """Sum of x_i * x_j over NULL-free rows; one aggregate, k(k+1)/2 sums."""
    clean = df.select(*[F.col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(cols)]).na.drop()
    exprs = [F.count(F.lit(1)).alias("n")]
    k = len(cols)
    for i in range(k):
        for j in range(i, k):
            exprs.append(F.sum(F.col(f"_x{i}") * F.col(f"_x{j}")).alias(f"g{i}_{j}"))
    row = clean.agg(*exprs).first()
    g = np.zeros((k, k))
    for i in range(k):
        for j in range(i, k):
            v = row[f"g{i}_{j}"] or 0.0
            g[i, j] = g[j, i] = v
    return g, int(row["n"])


def vif(df: DataFrame, cols: list[str]) -> DataFrame:
    """L3: uncentred variance inflation factors (regression of each column on
    the others without intercept), VIF_i = G_ii * (G^-1)_ii. Only the k x k
    Gram matrix is collected. Columns involved in an exact linear dependence
    get +inf (the R^2 of their regression is 1)."""
    g, n = gram_matrix(df, cols)
    spark = df.sparkSession
    k = len(cols)
    out = []
    if n == 0:
        vals = [None] * k
    else:
        d = np.sqrt(np.diag(g))
        d[d == 0] = 1.0
        gn = g / np.outer(d, d)  # unit-norm columns: condition number check
        cond = np.linalg.cond(gn)
        inv = np.linalg.pinv(gn)
        vals = []
        for i in range(k):
            if cond > 1e12:
                # singular: test whether column i is in the span of the others
                others = [j for j in range(k) if j != i]
                sub = gn[np.ix_(others, others)]
                b = gn[others, i]
                coef = np.linalg.lstsq(sub, b, rcond=None)[0]
                resid = 1.0 - float(b @ coef)
                vals.append(float("inf") if resid < 1e-10 else 1.0 / resid)
            else:
                vals.append(float(gn[i, i] * inv[i, i]))
    for c, v in zip(cols, vals):
        flag = None if v is None else ("high" if v > 10 else "moderate" if v > 5 else "low")
        out.append((c, v, flag))
    return spark.createDataFrame(out, "Feature string, VIF double, Level string")


def trend_fit(df: DataFrame, x: str, y: str, by: list[str] | None = None, fill_x: float | None = None) -> DataFrame:
    """Least-squares slope, intercept, r^2 and n (per group);
    ``fill_x`` replaces NULL x first (the reference fills 0 in one case)."""
    xs = F.coalesce(F.col(x), F.lit(fill_x)) if fill_x is not None else F.col(x)
    d = df.select(*(by or []), xs.alias("_x"), F.col(y).alias("_y"))
    aggs = [
        F.regr_slope("_y", "_x").alias("Slope"),
        F.regr_intercept("_y", "_x").alias("Intercept"),
        F.regr_r2("_y", "_x").alias("R2"),
        F.regr_count("_y", "_x").alias("N"),
        F.min("_x").alias("XMin"),
        F.max("_x").alias("XMax"),
    ]
    return d.groupBy(*by).agg(*aggs) if by else d.agg(*aggs)


def trend_line(fit: DataFrame, points: int = 200) -> DataFrame:
    """The fitted line sampled on an even grid between min and max x."""
    grid = fit.select(
        "*", F.posexplode(F.sequence(F.lit(0), F.lit(points - 1))).alias("_i", "_k")
    ).drop("_k")
    x = F.col("XMin") + (F.col("XMax") - F.col("XMin")) * F.col("_i") / F.lit(points - 1)
    return grid.select(F.col("_i").alias("Point"), x.alias("X"), (F.col("Intercept") + F.col("Slope") * x).alias("Y"))


def load_sensitivity(df: DataFrame, x: str, y: str, default: float = 500.0) -> DataFrame:
    """cov(x, y) / var(x) (sample), ``default`` when var is 0 or undefined."""
    return df.agg(
        F.covar_samp(x, y).alias("_cov"), F.var_samp(x).alias("_var")
    ).select(
        F.when((F.col("_var") == 0) | F.col("_var").isNull(), F.lit(default))
        .otherwise(F.col("_cov") / F.col("_var")).alias("Sensitivity")
    )


def histogram(df: DataFrame, x: str, bins: int = 80, log1p: bool = False) -> DataFrame:
    """``np.histogram(x, bins)``: equal-width over [min, max], last bin
    closed; empty bins included (bins are generated, not collected)."""
    v = F.log1p(F.col(x)) if log1p else F.col(x)
    d = df.select(v.alias("_v")).where(F.col("_v").isNotNull())
    mm = d.agg(F.min("_v").alias("_mn"), F.max("_v").alias("_mx"))
    w = (F.col("_mx") - F.col("_mn")) / bins
    idx = F.when(F.col("_mx") == F.col("_mn"), F.lit(bins // 2)).otherwise(
        F.least(F.floor((F.col("_v") - F.col("_mn")) / w), F.lit(bins - 1))
    ).cast("int")
    counts = with_scalars(d, mm).groupBy(idx.alias("Bin")).agg(F.count(F.lit(1)).alias("Count"))
    grid = mm.select("_mn", "_mx", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("Bin"))
    edges = grid.select(
        "Bin",
        F.when(F.col("_mx") == F.col("_mn"), F.col("_mn") - 0.5 + F.col("Bin") / F.lit(float(bins)))
        .otherwise(F.col("_mn") + F.col("Bin") * (F.col("_mx") - F.col("_mn")) / bins).alias("Low"),
        F.when(F.col("_mx") == F.col("_mn"), F.col("_mn") - 0.5 + (F.col("Bin") + 1) / F.lit(float(bins)))
        .otherwise(F.col("_mn") + (F.col("Bin") + 1) * (F.col("_mx") - F.col("_mn")) / bins).alias("High"),
    )
    return edges.join(counts, "Bin", "left").select("Bin", "Low", "High", F.coalesce("Count", F.lit(0)).cast("long").alias("Count"))


def box_summary(df: DataFrame, x: str, by: str) -> DataFrame:
    """Quartiles, IQR, 1.5 IQR whiskers (clamped to data), outlier
    count, mean and n per group; exact quantiles without a per-group sort."""
    d = df.where(F.col(by).isNotNull())
    q = exact_quantiles(d, x, {"Q1": 0.25, "Median": 0.5, "Q3": 0.75}, by=[by], write=True)
    q = q.withColumn("IQR", F.col("Q3") - F.col("Q1")).withColumns(
        {"_lf": F.col("Q1") - 1.5 * F.col("IQR"), "_uf": F.col("Q3") + 1.5 * F.col("IQR")}
    )
    from .sizing import measured_broadcast

    j = d.select(by, x).join(measured_broadcast(q), by)
    inside = (F.col(x) >= F.col("_lf")) & (F.col(x) <= F.col("_uf"))
    agg = j.groupBy(by).agg(
        F.min(F.when(inside, F.col(x))).alias("WhiskerLow"),
        F.max(F.when(inside, F.col(x))).alias("WhiskerHigh"),
        F.count_if(~inside).alias("Outliers"),
        F.avg(x).alias("Mean"),
        F.count(x).alias("N"),
    )
    return q.drop("_lf", "_uf").join(agg, by)


def deterministic_sample(df: DataFrame, n: int, key_cols: list[str], seed: int = 42) -> DataFrame:
    """A fixed sample of min(n, rows): the n rows with the smallest
    xxhash64(key, seed) (a top-k, so one bounded heap per task)."""
    h = F.xxhash64(*[F.col(c) for c in key_cols], F.lit(seed))
    return df.withColumn("_h", h).orderBy("_h", *key_cols).limit(n).drop("_h")


def top_n_per_group(df: DataFrame, group: str, order: str, n: int, tie: str | None = None) -> DataFrame:
    """Rank (1-based) within group by ``order`` desc, keep the top n."""
    w = Window.partitionBy(group).orderBy(F.desc(order), *( [F.asc(tie)] if tie else []))
    return df.withColumn("Rank", F.row_number().over(w)).where(F.col("Rank") <= n)


def normalise_by_group_max(df: DataFrame, group: str, value: str) -> DataFrame:
    """Value / max(value) within group when that max is > 0."""
    from .sizing import measured_broadcast

    m = measured_broadcast(df.groupBy(group).agg(F.max(value).alias("_gmax")))
    return df.join(m, group, "left").withColumn(
        "Normalised", F.when(F.col("_gmax") > 0, F.col(value) / F.col("_gmax")).otherwise(F.col(value))
    ).drop("_gmax")


def normalise_by_total(df: DataFrame, group: str, value: str) -> DataFrame:
    """|value| / sum |value| within group."""
    from .sizing import measured_broadcast

    t = measured_broadcast(df.groupBy(group).agg(F.sum(F.abs(value)).alias("_tot")))
    return df.join(t, group, "left").withColumn(
        "Share", F.when(F.col("_tot") == 0, F.lit(None)).otherwise(F.abs(value) / F.col("_tot"))
    ).drop("_tot")
