"""Second half of the registered queries: statistics (L1-L8, A33-A35),
window / top-k operators (W1-W4, T1-T6, A32, A38, A42), sampling (P10, P11,
P13), fallbacks (A27-A31), lookups / formatting (J11, M32), the real
time-of-day path on ``events`` (M1, M2, M12) and the ML layer (rows-only)."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import config as C
from ..functions import scalar as S
from ..operators import ml, predict, residuals, segments, stats, value, views
from . import stages
from .catalog import (
    _ROUTE_OPP_SQL,
    _SEG_OPP_SQL,
    _eng,
    _flights,
    _resid,
    _route_opp,
    _seg_opp,
    query,
)
from .oracle_base import fsum

# ---------------------------------------------------------------------------
# Distributions


def _hist_sql(expr: str, src: str, bins: int) -> str:
    return f"""
    WITH d AS (SELECT {expr} AS v FROM {src} WHERE {expr} IS NOT NULL),
    mm AS (SELECT min(v) AS mn, max(v) AS mx FROM d),
    c AS (SELECT CAST(CASE WHEN mx = mn THEN {bins // 2} ELSE least(floor((v - mn) / ((mx - mn) / {bins})), {bins - 1}) END AS INTEGER) AS Bin,
                 count(*) AS Count FROM d CROSS JOIN mm GROUP BY 1),
    g AS (SELECT CAST(b.range AS INTEGER) AS Bin, mn, mx FROM mm CROSS JOIN range(0, {bins}) b)
    SELECT g.Bin,
           CASE WHEN mx = mn THEN mn - 0.5 + g.Bin / CAST({bins} AS DOUBLE) ELSE mn + g.Bin * (mx - mn) / {bins} END AS Low,
           CASE WHEN mx = mn THEN mn - 0.5 + (g.Bin + 1) / CAST({bins} AS DOUBLE) ELSE mn + (g.Bin + 1) * (mx - mn) / {bins} END AS High,
           CAST(coalesce(c.Count, 0) AS BIGINT) AS Count
    FROM g LEFT JOIN c ON g.Bin = c.Bin
    """


@query("histogram", _hist_sql("Burnoff", "eng", 80), "Bin, Low:d, High:d, Count")
def histogram(spark, sf):
    """80-bin histogram of the target (empty bins included)."""
    return stats.histogram(_eng(spark, sf), C.TARGET, 80)


@query("histogram_log1p", _hist_sql("ln(1 + Burnoff)", "eng", 80), "Bin, Low:d, High:d, Count")
def histogram_log1p(spark, sf):
    """80-bin histogram of log1p(target)."""
    return stats.histogram(_eng(spark, sf), C.TARGET, 80, log1p=True)


@query("zscore_histogram", _hist_sql("ResidualZ_segment", "flights", 70), "Bin, Low:d, High:d, Count")
def zscore_histogram(spark, sf):
    """70-bin histogram of segment z-scores."""
    return stats.histogram(_flights(spark, sf), "ResidualZ_segment", 70)


_BOX_SQL = """
WITH d AS (SELECT AircraftTypeGroup, Burnoff FROM eng WHERE AircraftTypeGroup IS NOT NULL AND Burnoff IS NOT NULL),
q AS (SELECT AircraftTypeGroup, quantile_cont(Burnoff, 0.25) AS Q1, quantile_cont(Burnoff, 0.5) AS Median,
             quantile_cont(Burnoff, 0.75) AS Q3 FROM d GROUP BY 1),
q2 AS (SELECT *, Q3 - Q1 AS IQR, Q1 - 1.5 * (Q3 - Q1) AS lf, Q3 + 1.5 * (Q3 - Q1) AS uf FROM q)
SELECT q2.AircraftTypeGroup, Q1, Median, Q3, IQR,
       min(CASE WHEN Burnoff >= lf AND Burnoff <= uf THEN Burnoff END) AS WhiskerLow,
       max(CASE WHEN Burnoff >= lf AND Burnoff <= uf THEN Burnoff END) AS WhiskerHigh,
       count(*) FILTER (WHERE NOT (Burnoff >= lf AND Burnoff <= uf)) AS Outliers,
       avg(Burnoff) AS Mean, count(Burnoff) AS N
FROM d JOIN q2 ON d.AircraftTypeGroup = q2.AircraftTypeGroup
GROUP BY q2.AircraftTypeGroup, Q1, Median, Q3, IQR
"""


@query(
    "box_summary",
    _BOX_SQL,
    "AircraftTypeGroup, Q1:d, Median:d, Q3:d, IQR:d, WhiskerLow:d, WhiskerHigh:d, Outliers, Mean:d, N",
)
def box_summary(spark, sf):
    """Box / violin summary of the target per aircraft type."""
    return stats.box_summary(_eng(spark, sf), C.TARGET, "AircraftTypeGroup")


@query(
    "group_iqr",
    f"""
    WITH b AS ({_BOX_SQL})
    SELECT AircraftTypeGroup, IQR, Median, Mean,
           AircraftTypeGroup = (SELECT arg_max(AircraftTypeGroup, IQR) FROM b) AS IsWidest,
           AircraftTypeGroup = (SELECT arg_min(AircraftTypeGroup, Median) FROM b) AS IsLowestMedian
    FROM b
    """,
    "AircraftTypeGroup, IQR:d, Median:d, Mean:d, IsWidest, IsLowestMedian",
)
def group_iqr(spark, sf):
    """IQR, median and mean per type with arg-max / arg-min labels."""
    from ..operators.sizing import with_scalars

    b = stats.box_summary(_eng(spark, sf), C.TARGET, "AircraftTypeGroup")
    lab = b.agg(
        F.max_by("AircraftTypeGroup", "IQR").alias("_w"), F.min_by("AircraftTypeGroup", "Median").alias("_l")
    )
    return with_scalars(b, lab).select(
        "AircraftTypeGroup", "IQR", "Median", "Mean",
        (F.col("AircraftTypeGroup") == F.col("_w")).alias("IsWidest"),
        (F.col("AircraftTypeGroup") == F.col("_l")).alias("IsLowestMedian"),
    )


# ---------------------------------------------------------------------------
# Correlation, trends, VIF


def _corr_sql(cols: list[str], src: str) -> str:
    parts = []
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            if i == j:
                parts.append(f"SELECT '{a}' AS FeatureA, '{b}' AS FeatureB, CAST(1.0 AS DOUBLE) AS Corr")
            else:
                r = f"corr({cols[min(i, j)]}, {cols[max(i, j)]})"
                parts.append(f"SELECT '{a}' AS FeatureA, '{b}' AS FeatureB, {r} AS Corr FROM {src}")
    return "\nUNION ALL\n".join(parts)


@query("corr_matrix", _corr_sql(C.CORR_COLUMNS, "eng"), "FeatureA, FeatureB, Corr:d")
def corr_matrix(spark, sf):
    """L1: Pearson matrix of 10 columns, long form, one aggregate pass."""
    return stats.corr_long(_eng(spark, sf), C.CORR_COLUMNS)


@query(
    "strongest_pairs",
    f"""
    WITH c AS ({_corr_sql(C.CORR_COLUMNS, 'eng')}),
    off AS (SELECT * FROM c WHERE FeatureA <> FeatureB)
    SELECT * FROM (SELECT 'target' AS Kind, FeatureA, FeatureB, Corr FROM off WHERE FeatureA = 'Burnoff'
                   ORDER BY abs(Corr) DESC, FeatureB LIMIT 1)
    UNION ALL
    SELECT * FROM (SELECT 'pair', FeatureA, FeatureB, Corr FROM off WHERE FeatureA < FeatureB
                   ORDER BY abs(Corr) DESC, FeatureA, FeatureB LIMIT 1)
    """,
    "Kind, FeatureA, FeatureB, Corr:d",
)
def strongest_pairs(spark, sf):
    """Strongest correlate of the target and strongest pair."""
    return stats.strongest_pairs(stats.corr_long(_eng(spark, sf), C.CORR_COLUMNS), C.TARGET)


@query("vif")
def vif(spark, sf):
    """L3: uncentred VIF of 11 features from a one-pass Gram matrix (rows-only:
    needs a matrix inverse)."""
    return stats.vif(_eng(spark, sf), C.VIF_COLUMNS)


_TREND_SQL = """
SELECT regr_slope(AbsError, coalesce(RouteDistanceKm, 0.0)) AS Slope, regr_intercept(AbsError, coalesce(RouteDistanceKm, 0.0)) AS Intercept,
       regr_r2(AbsError, coalesce(RouteDistanceKm, 0.0)) AS R2, CAST(regr_count(AbsError, coalesce(RouteDistanceKm, 0.0)) AS BIGINT) AS N,
       min(coalesce(RouteDistanceKm, 0.0)) AS XMin, max(coalesce(RouteDistanceKm, 0.0)) AS XMax
FROM resid
"""


@query("trend_fit", _TREND_SQL, "Slope:d, Intercept:d, R2:d, N, XMin:d, XMax:d")
def trend_fit(spark, sf):
    """L4: degree-1 least squares of abs error on distance (NULL x -> 0)."""
    return stats.trend_fit(_resid(spark, sf), "RouteDistanceKm", "AbsError", fill_x=0.0)


@query(
    "trend_line",
    f"""
    SELECT CAST(g.range AS INTEGER) AS Point, XMin + (XMax - XMin) * g.range / 199 AS X,
           Intercept + Slope * (XMin + (XMax - XMin) * g.range / 199) AS Y
    FROM ({_TREND_SQL}) t CROSS JOIN range(0, 200) g
    """,
    "Point, X:d, Y:d",
)
def trend_line(spark, sf):
    """The fitted trend sampled on a 200-point grid."""
    return stats.trend_line(stats.trend_fit(_resid(spark, sf), "RouteDistanceKm", "AbsError", fill_x=0.0), 200)


@query(
    "trend_by_type",
    "SELECT AircraftTypeGroup, regr_slope(Burnoff, PlannedTripTime / 60) AS Slope, "
    "regr_intercept(Burnoff, PlannedTripTime / 60) AS Intercept, regr_r2(Burnoff, PlannedTripTime / 60) AS R2, "
    "CAST(regr_count(Burnoff, PlannedTripTime / 60) AS BIGINT) AS N, min(PlannedTripTime / 60) AS XMin, "
    "max(PlannedTripTime / 60) AS XMax FROM eng GROUP BY 1",
    "AircraftTypeGroup, Slope:d, Intercept:d, R2:d, N, XMin:d, XMax:d",
)
def trend_by_type(spark, sf):
    """OLS trend of burn on trip minutes per aircraft type."""
    e = _eng(spark, sf).withColumn("_tt", F.col("PlannedTripTime") / 60)
    return stats.trend_fit(e, "_tt", C.TARGET, by=["AircraftTypeGroup"])


@query(
    "pair_correlation",
    "SELECT corr(PlannedTripTime, Burnoff) AS TripTimeCorr, corr(LoadFactor, Burnoff) AS LoadCorr, "
    "corr(RouteDistanceKm, Burnoff) AS DistanceCorr FROM eng",
    "TripTimeCorr:d, LoadCorr:d, DistanceCorr:d",
)
def pair_correlation(spark, sf):
    """Single-pair correlations used on the EDA tab."""
    return _eng(spark, sf).agg(
        F.corr("PlannedTripTime", C.TARGET).alias("TripTimeCorr"),
        F.corr("LoadFactor", C.TARGET).alias("LoadCorr"),
        F.corr("RouteDistanceKm", C.TARGET).alias("DistanceCorr"),
    )


@query(
    "load_sensitivity",
    "SELECT CASE WHEN var_samp(LoadFactor) = 0 OR var_samp(LoadFactor) IS NULL THEN 500.0 "
    "ELSE covar_samp(LoadFactor, Burnoff) / var_samp(LoadFactor) END AS Sensitivity FROM eng",
    "Sensitivity:d",
)
def load_sensitivity(spark, sf):
    """cov(load, burn) / var(load), 500 when the variance is 0."""
    return stats.load_sensitivity(_eng(spark, sf), "LoadFactor", C.TARGET)


# ---------------------------------------------------------------------------
# Quantile subsets and samples


@query(
    "quantile_tails",
    """
    WITH q AS (SELECT quantile_cont(LoadFactor, 0.2) AS lo, quantile_cont(LoadFactor, 0.8) AS hi FROM eng)
    SELECT first(lo) AS CutLow, first(hi) AS CutHigh, avg(CASE WHEN LoadFactor <= lo THEN Burnoff END) AS MeanLowTail,
           avg(CASE WHEN LoadFactor >= hi THEN Burnoff END) AS MeanHighTail,
           avg(CASE WHEN LoadFactor >= hi THEN Burnoff END) - avg(CASE WHEN LoadFactor <= lo THEN Burnoff END) AS TailGap
    FROM eng CROSS JOIN q
    """,
    "CutLow:d, CutHigh:d, MeanLowTail:d, MeanHighTail:d, TailGap:d",
)
def quantile_tails(spark, sf):
    """Mean burn in the bottom-20 % and top-20 % load tails."""
    return residuals.quantile_tails(_eng(spark, sf), "LoadFactor", C.TARGET, 0.2, 0.8)


@query(
    "trim_p99",
    "SELECT OrderKey, ActualBurn_kg, ExcessBurn_kg, LoadFactor FROM flights "
    "WHERE ActualBurn_kg <= (SELECT quantile_cont(ActualBurn_kg, 0.99) FROM flights)",
    "OrderKey, ActualBurn_kg, ExcessBurn_kg, LoadFactor",
)
def trim_p99(spark, sf):
    """P10: rows at or below the exact 99th percentile of burn."""
    return residuals.trim_above_quantile(_flights(spark, sf), "ActualBurn_kg", 0.99).select(
        "OrderKey", "ActualBurn_kg", "ExcessBurn_kg", "LoadFactor"
    )


_SAMPLE_KEY = ["OrderKey", "Children", "Adults", "ScheduledRoute", "AircraftTypeGroup"]


@query(
    "det_sample",
    "SELECT OrderKey, Children, Adults, ScheduledRoute, AircraftTypeGroup, Burnoff, PlannedTripTime FROM eng "
    "ORDER BY md5(concat_ws('|', CAST(OrderKey AS VARCHAR), CAST(Children AS VARCHAR), CAST(Adults AS VARCHAR), "
    "ScheduledRoute, AircraftTypeGroup, '42')), OrderKey, Children, Adults LIMIT 5000",
    "OrderKey, Children, Adults, ScheduledRoute, AircraftTypeGroup, Burnoff, PlannedTripTime",
)
def det_sample(spark, sf):
    """A fixed, engine-independent sample of min(5000, rows): the
    rows with the smallest md5(key | seed) (top-k with bounded heaps)."""
    e = _eng(spark, sf)
    h = F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in _SAMPLE_KEY], F.lit(str(C.SEED))))
    return e.withColumn("_h", h).orderBy("_h", "OrderKey", "Children", "Adults").limit(5000).select(
        *_SAMPLE_KEY, C.TARGET, "PlannedTripTime"
    )


# ---------------------------------------------------------------------------
# Windows, ranking, top-k


@query(
    "topn_per_group",
    f"""
    SELECT AircraftTypeMode, ScheduledRoute, OpportunityScore, CAST(Rank AS INTEGER) AS Rank FROM (
      SELECT AircraftTypeMode, ScheduledRoute, OpportunityScore,
             row_number() OVER (PARTITION BY AircraftTypeMode ORDER BY OpportunityScore DESC, ScheduledRoute) AS Rank
      FROM ({_ROUTE_OPP_SQL})) WHERE Rank <= 5
    """,
    "AircraftTypeMode, ScheduledRoute, OpportunityScore:d, Rank",
)
def topn_per_group(spark, sf):
    """Top-5 routes by opportunity within each modal aircraft type."""
    ro = _route_opp(spark, sf).select("AircraftTypeMode", "ScheduledRoute", "OpportunityScore")
    return stats.top_n_per_group(ro, "AircraftTypeMode", "OpportunityScore", 5, tie="ScheduledRoute")


@query(
    "norm_by_group_max",
    """
    WITH f AS (SELECT AircraftTypeGroup, ScheduledRoute, count(*) AS Flights FROM eng
               WHERE AircraftTypeGroup IS NOT NULL AND ScheduledRoute IS NOT NULL GROUP BY 1, 2)
    SELECT f.*, CASE WHEN m.mx > 0 THEN Flights / CAST(m.mx AS DOUBLE) ELSE CAST(Flights AS DOUBLE) END AS Normalised
    FROM f LEFT JOIN (SELECT AircraftTypeGroup, max(Flights) AS mx FROM f GROUP BY 1) m ON f.AircraftTypeGroup = m.AircraftTypeGroup
    """,
    "AircraftTypeGroup, ScheduledRoute, Flights, Normalised:d",
)
def norm_by_group_max(spark, sf):
    """Route volume normalised by the busiest route of its type."""
    f = _eng(spark, sf).where(F.col("AircraftTypeGroup").isNotNull() & F.col("ScheduledRoute").isNotNull())
    g = f.groupBy("AircraftTypeGroup", "ScheduledRoute").agg(F.count(F.lit(1)).alias("Flights"))
    return stats.normalise_by_group_max(g, "AircraftTypeGroup", "Flights").withColumn(
        "Normalised", F.col("Normalised").cast("double")
    )


@query(
    "norm_by_total",
    f"""
    WITH s AS ({_SEG_OPP_SQL})
    SELECT s.SegmentType, s.SegmentName, s.MeanExcessBurn,
           CASE WHEN t.tot = 0 THEN NULL ELSE abs(s.MeanExcessBurn) / t.tot END AS Share
    FROM s LEFT JOIN (SELECT SegmentType, sum(abs(MeanExcessBurn)) AS tot FROM s GROUP BY 1) t ON s.SegmentType = t.SegmentType
    """,
    "SegmentType, SegmentName, MeanExcessBurn:d, Share:d",
)
def norm_by_total(spark, sf):
    """|mean excess| as a share of its segment type's total."""
    s = _seg_opp(spark, sf).select("SegmentType", "SegmentName", "MeanExcessBurn")
    return stats.normalise_by_total(s, "SegmentType", "MeanExcessBurn")


@query(
    "route_volume_top50",
    "SELECT ScheduledRoute, count(*) AS Flights FROM eng WHERE ScheduledRoute IS NOT NULL GROUP BY 1 "
    "ORDER BY Flights DESC, ScheduledRoute LIMIT 50",
    "ScheduledRoute, Flights",
)
def route_volume_top50(spark, sf):
    """Value counts of routes, top 50."""
    return (
        _eng(spark, sf).where(F.col("ScheduledRoute").isNotNull()).groupBy("ScheduledRoute")
        .agg(F.count(F.lit(1)).alias("Flights")).orderBy(F.desc("Flights"), "ScheduledRoute").limit(50)
    )


_IMP_FEATURES = ["PlannedTripTime", "PlannedTOW", "RouteDistanceKm", "LoadFactor", "TotalPassengers", "BlockTimeScheduled"]


def _imp_sql() -> str:
    parts = [
        f"SELECT AircraftTypeGroup AS Model, '{f}' AS Feature, round_even(abs(corr({f}, Burnoff)), 10) AS Importance FROM eng "
        f"WHERE AircraftTypeGroup IS NOT NULL GROUP BY 1"
        for f in _IMP_FEATURES
    ]
    return "\nUNION ALL\n".join(parts)


@query(
    "consensus_rank",
    f"""
    WITH imp AS ({_imp_sql()}),
    r AS (SELECT *, row_number() OVER (PARTITION BY Model ORDER BY Importance DESC, Feature) AS Rank FROM imp)
    SELECT Feature, count(DISTINCT Model) FILTER (WHERE Rank <= 3) AS ModelsTop3, avg(Rank) AS MeanRank
    FROM r GROUP BY 1
    """,
    "Feature, ModelsTop3, MeanRank:d",
)
def consensus_rank(spark, sf):
    """Importance consensus (|corr| with the target per aircraft-type
    model): how many models rank a feature top-3, and its mean rank."""
    e = _eng(spark, sf).where(F.col("AircraftTypeGroup").isNotNull())
    g = e.groupBy(F.col("AircraftTypeGroup").alias("Model")).agg(
        # rounded so that exactly collinear features tie exactly (name tie-break)
        *[F.bround(F.abs(F.corr(f, C.TARGET)), 10).alias(f) for f in _IMP_FEATURES]
    )
    imp = g.unpivot(["Model"], _IMP_FEATURES, "Feature", "Importance")
    r = stats.top_n_per_group(imp, "Model", "Importance", len(_IMP_FEATURES), tie="Feature")
    return r.groupBy("Feature").agg(
        F.count_distinct(F.when(F.col("Rank") <= 3, F.col("Model"))).alias("ModelsTop3"),
        F.avg("Rank").alias("MeanRank"),
    )


#: The naive benchmark: the mean per aircraft type.
_BASELINE = "MeanByType"
_BENCH_MODELS = {
    "GlobalMean": [],
    "MeanByType": ["AircraftTypeGroup"],
    "MeanByRoute": ["ScheduledRoute"],
    "MeanByRouteType": ["ScheduledRoute", "AircraftTypeGroup"],
    "MeanByCarrier": ["Carrier"],
}


def _bench_sql() -> str:
    parts = []
    for name, keys in _BENCH_MODELS.items():
        mean = "CAST(sum(CAST(Burnoff AS DECIMAL(38,6))) AS DOUBLE) / count(Burnoff)"
        if keys:
            k = ", ".join(keys)
            on = " AND ".join(f"v.{c} = m.{c}" for c in keys)
            nn = " AND ".join(f"{c} IS NOT NULL" for c in keys)
            fit = f"SELECT {k}, {mean} AS p FROM splitf WHERE NOT IsValidation AND {nn} GROUP BY {k}"
            parts.append(
                f"SELECT '{name}' AS Model, v.Burnoff AS y, m.p AS yhat FROM splitf v JOIN ({fit}) m ON {on} WHERE v.IsValidation"
            )
        else:
            fit = f"SELECT {mean} AS p FROM splitf WHERE NOT IsValidation"
            parts.append(f"SELECT '{name}' AS Model, v.Burnoff AS y, m.p AS yhat FROM splitf v CROSS JOIN ({fit}) m WHERE v.IsValidation")
    return "\nUNION ALL\n".join(parts)


@query(
    "scoreboard_gaps",
    f"""
    WITH p AS ({_bench_sql()}),
    m AS (SELECT Model, sqrt(avg((yhat - y) * (yhat - y))) AS RMSE,
                 avg(abs(yhat - y) / greatest(abs(y), CAST(2.220446049250313e-16 AS DOUBLE))) * 100 AS MAPE
          FROM p WHERE y IS NOT NULL AND yhat IS NOT NULL GROUP BY 1),
    r AS (SELECT *, row_number() OVER (ORDER BY RMSE, Model) AS rk, row_number() OVER (ORDER BY RMSE DESC, Model) AS rw,
                 row_number() OVER (ORDER BY MAPE, Model) AS mk, row_number() OVER (ORDER BY MAPE DESC, Model) AS mw FROM m)
    SELECT b.Model AS BestModel, b.RMSE AS BestRMSE, s.Model AS RunnerUp, s.RMSE AS RunnerUpRMSE, w.Model AS WorstModel,
           w.RMSE AS WorstRMSE, s.RMSE - b.RMSE AS GapToRunnerUp,
           (g.RMSE - b.RMSE) / g.RMSE * 100 AS ImprovementOverBaselinePct,
           mb.Model AS BestByMAPE, mb.MAPE AS BestMAPE, ms.Model AS RunnerUpByMAPE, ms.MAPE - mb.MAPE AS MAPEGapToRunnerUp,
           mx.Model AS WorstByMAPE, mx.MAPE AS WorstMAPE
    FROM (SELECT * FROM r WHERE rk = 1) b, (SELECT * FROM r WHERE rk = 2) s, (SELECT * FROM r WHERE rw = 1) w,
         (SELECT * FROM r WHERE mk = 1) mb, (SELECT * FROM r WHERE mk = 2) ms, (SELECT * FROM r WHERE mw = 1) mx,
         (SELECT * FROM m WHERE Model = '{_BASELINE}') g
    """,
    "BestModel, BestRMSE:d, RunnerUp, RunnerUpRMSE:d, WorstModel, WorstRMSE:d, GapToRunnerUp:d, "
    "ImprovementOverBaselinePct:d, BestByMAPE, BestMAPE:d, RunnerUpByMAPE, MAPEGapToRunnerUp:d, WorstByMAPE, WorstMAPE:d",
)
def scoreboard_gaps(spark, sf):
    """A42/ML11/ML12: scoreboard of group-mean benchmarks fitted on the
    training split and scored on validation: best, runner-up, worst and gaps by
    RMSE and by MAPE, and the gain over the naive mean per aircraft type."""
    from pyspark.sql import Window

    from ..operators.sizing import with_scalars

    s = predict.hash_split(_eng(spark, sf))
    train, val = s.where(~F.col("IsValidation")), s.where(F.col("IsValidation"))
    stacked = None
    for name, keys in _BENCH_MODELS.items():
        if keys:
            nn = F.lit(True)
            for k in keys:
                nn = nn & F.col(k).isNotNull()
            fit = train.where(nn).groupBy(*keys).agg(predict.exact_mean(C.TARGET).alias("_p"))
            from ..operators.sizing import measured_broadcast

            p = val.join(measured_broadcast(fit), keys)
        else:
            p = with_scalars(val, train.agg(predict.exact_mean(C.TARGET).alias("_p")))
        part = p.select(F.lit(name).alias("Model"), F.col(C.TARGET).alias("y"), F.col("_p").alias("yhat"))
        stacked = part if stacked is None else stacked.unionByName(part)
    e = F.col("yhat") - F.col("y")
    m = stacked.where(F.col("y").isNotNull() & F.col("yhat").isNotNull()).groupBy("Model").agg(
        F.sqrt(F.avg(e * e)).alias("RMSE"),
        (F.avg(F.abs(e) / F.greatest(F.abs("y"), F.lit(2.220446049250313e-16))) * 100).alias("MAPE"),
    )
    # one row per model: the ranking window sees a handful of rows
    r = m.withColumns({
        "rk": F.row_number().over(Window.orderBy("RMSE", "Model")),
        "rw": F.row_number().over(Window.orderBy(F.desc("RMSE"), "Model")),
        "mk": F.row_number().over(Window.orderBy("MAPE", "Model")),
        "mw": F.row_number().over(Window.orderBy(F.desc("MAPE"), "Model")),
    })
    one = r.agg(
        F.max(F.when(F.col("rk") == 1, F.col("Model"))).alias("BestModel"),
        F.max(F.when(F.col("rk") == 1, F.col("RMSE"))).alias("BestRMSE"),
        F.max(F.when(F.col("rk") == 2, F.col("Model"))).alias("RunnerUp"),
        F.max(F.when(F.col("rk") == 2, F.col("RMSE"))).alias("RunnerUpRMSE"),
        F.max(F.when(F.col("rw") == 1, F.col("Model"))).alias("WorstModel"),
        F.max(F.when(F.col("rw") == 1, F.col("RMSE"))).alias("WorstRMSE"),
        F.max(F.when(F.col("mk") == 1, F.col("Model"))).alias("BestByMAPE"),
        F.max(F.when(F.col("mk") == 1, F.col("MAPE"))).alias("BestMAPE"),
        F.max(F.when(F.col("mk") == 2, F.col("Model"))).alias("RunnerUpByMAPE"),
        F.max(F.when(F.col("mk") == 2, F.col("MAPE"))).alias("_second"),
        F.max(F.when(F.col("mw") == 1, F.col("Model"))).alias("WorstByMAPE"),
        F.max(F.when(F.col("mw") == 1, F.col("MAPE"))).alias("WorstMAPE"),
        F.max(F.when(F.col("Model") == _BASELINE, F.col("RMSE"))).alias("_g"),
    )
    return one.select(
        "BestModel", "BestRMSE", "RunnerUp", "RunnerUpRMSE", "WorstModel", "WorstRMSE",
        (F.col("RunnerUpRMSE") - F.col("BestRMSE")).alias("GapToRunnerUp"),
        ((F.col("_g") - F.col("BestRMSE")) / F.col("_g") * 100).alias("ImprovementOverBaselinePct"),
        "BestByMAPE", "BestMAPE", "RunnerUpByMAPE", (F.col("_second") - F.col("BestMAPE")).alias("MAPEGapToRunnerUp"),
        "WorstByMAPE", "WorstMAPE",
    )


# ---------------------------------------------------------------------------
# Lookups, formatting, events time path


@query(
    "metric_lookup",
    "SELECT Metric, Value FROM ("
    + __import__("burnlens.plans.catalog", fromlist=["_vs_sql"])._vs_sql()
    + ") WHERE Metric IN ('Model RMSE (kg)', 'Baseline RMSE (kg)', 'Total annual value (EUR)')",
    "Metric, Value:d",
)
def metric_lookup(spark, sf):
    """Look up named metrics in the key/value summary."""
    v = value.value_summary(_flights(spark, sf))
    return v.where(F.col("Metric").isin("Model RMSE (kg)", "Baseline RMSE (kg)", "Total annual value (EUR)")).select(
        "Metric", "Value"
    )


@query(
    "events_hour_bands",
    f"""
    SELECT {__import__('burnlens.plans.oracle_base', fromlist=['_case_hour_band'])._case_hour_band('CAST(hour(ts) AS INTEGER)')} AS HourBand,
           CAST(isodow(ts) - 1 AS INTEGER) AS DayOfWeek, count(*) AS Events, avg(value) AS MeanValue
    FROM events GROUP BY 1, 2
    """,
    "HourBand, DayOfWeek, Events, MeanValue:d",
)
def events_hour_bands(spark, sf):
    """M1/M2/M12 on real timestamps: events per hour band and weekday."""
    ev = spark.read.parquet(f"{sf}/events.parquet")
    return ev.groupBy(
        S.hour_band(F.hour("ts")).alias("HourBand"), F.weekday("ts").alias("DayOfWeek")
    ).agg(F.count(F.lit(1)).alias("Events"), F.avg("value").alias("MeanValue"))


# ---------------------------------------------------------------------------
# Fallbacks


def _ff(spark, sf):
    d = residuals.residuals(predict.with_benchmark(_eng(spark, sf)))
    return views.fallback_flights(d)


def _ff_sql() -> str:
    from .catalog import _cut_sql

    return f"""
    SELECT resid.*, Excess AS ExcessBurn_kg,
           (CASE WHEN Excess IS NULL THEN NULL ELSE greatest(Excess, 0.0) END) * CAST({C.CO2_PER_KG_FUEL} AS DOUBLE) AS AvoidableCO2_kg,
           (CASE WHEN Excess IS NULL THEN NULL ELSE greatest(Excess, 0.0) END) * CAST({C.FUEL_PRICE_PER_KG} AS DOUBLE) AS AvoidableFuelCost_eur,
           coalesce(AbsError > (SELECT avg(AbsError) + 2 * stddev_samp(AbsError) FROM resid), false) AS IsAnomaly,
           CASE WHEN coalesce(Excess > 0, false) THEN 'Over-consumption' ELSE 'Under-consumption' END AS AnomalyType,
           {_cut_sql('DepartureHour', C.FALLBACK_HOUR_EDGES, C.FALLBACK_HOUR_LABELS)} AS DepartureHourBand,
           {_cut_sql('LoadFactor', C.FALLBACK_LOAD_EDGES, C.FALLBACK_LOAD_LABELS)} AS LoadFactorBand,
           {_cut_sql('RouteDistanceKm', C.FALLBACK_DIST_EDGES, C.FALLBACK_DIST_LABELS)} AS DistanceBand
    FROM resid
    """


@query(
    "fallback_flights",
    f"SELECT IsAnomaly, AnomalyType, DepartureHourBand, LoadFactorBand, DistanceBand, count(*) AS Flights, "
    f"avg(AvoidableCO2_kg) AS MeanAvoidableCO2_kg FROM ({_ff_sql()}) GROUP BY 1, 2, 3, 4, 5",
    "IsAnomaly, AnomalyType, DepartureHourBand, LoadFactorBand, DistanceBand, Flights, MeanAvoidableCO2_kg:d",
)
def fallback_flights(spark, sf):
    """Fallback flight layer (two-sigma rule, right-closed bands),
    summarised per label combination."""
    return _ff(spark, sf).groupBy("IsAnomaly", "AnomalyType", "DepartureHourBand", "LoadFactorBand", "DistanceBand").agg(
        F.count(F.lit(1)).alias("Flights"), F.avg("AvoidableCO2_kg").alias("MeanAvoidableCO2_kg")
    )


_FB_ROUTE_SQL = f"""
SELECT ScheduledRoute, count(*) AS FlightCount, avg(ExcessBurn_kg) AS MeanExcessBurn,
       coalesce({fsum('AvoidableFuelCost_eur')}, 0.0) AS AnnualAvoidableCost_eur,
       coalesce({fsum('AvoidableCO2_kg')}, 0.0) / 1000 AS AnnualAvoidableCO2_t,
       avg(CAST(IsAnomaly AS DOUBLE)) AS AnomalyRate, avg(RouteDistanceKm) AS MeanDistanceKm, avg(LoadFactor) AS MeanLoadFactor,
       coalesce({fsum('AvoidableFuelCost_eur')}, 0.0) * ln(1 + count(*)) AS OpportunityScore
FROM ({_ff_sql()}) WHERE ScheduledRoute IS NOT NULL GROUP BY 1
"""
_FB_ROUTE_COLS = (
    "ScheduledRoute, FlightCount, MeanExcessBurn:d, AnnualAvoidableCost_eur, AnnualAvoidableCO2_t, AnomalyRate, "
    "MeanDistanceKm:d, MeanLoadFactor:d, OpportunityScore:d"
)


@query("fallback_route_opportunity", _FB_ROUTE_SQL, _FB_ROUTE_COLS)
def fallback_route_opportunity(spark, sf):
    """Fallback route opportunity (sum cost, log1p volume score)."""
    return views.fallback_route_opportunity(_ff(spark, sf))


@query(
    "fallback_segment_opportunity",
    f"""
    SELECT AircraftTypeGroup AS SegmentName, count(*) AS FlightCount, avg(ExcessBurn_kg) AS MeanExcessBurn,
           coalesce({fsum('AvoidableFuelCost_eur')}, 0.0) AS AnnualAvoidableCost_eur, coalesce({fsum('AvoidableCO2_kg')}, 0.0) / 1000 AS AnnualAvoidableCO2_t,
           avg(CAST(IsAnomaly AS DOUBLE)) AS AnomalyRate, 'Aircraft' AS SegmentType,
           coalesce({fsum('AvoidableFuelCost_eur')}, 0.0) * ln(1 + count(*)) AS OpportunityScore
    FROM ({_ff_sql()}) WHERE AircraftTypeGroup IS NOT NULL GROUP BY 1
    """,
    "SegmentName, FlightCount, MeanExcessBurn:d, AnnualAvoidableCost_eur, AnnualAvoidableCO2_t, AnomalyRate, SegmentType, OpportunityScore:d",
)
def fallback_segment_opportunity(spark, sf):
    """Fallback segment table by aircraft type."""
    return views.fallback_segment_opportunity(_ff(spark, sf))


@query(
    "fallback_anomaly_monitor",
    f"""
    WITH g AS (SELECT ScheduledRoute AS SegmentName, count(*) AS FlightCount, count(*) FILTER (WHERE IsAnomaly) AS AnomalyCount,
                      avg(CAST(IsAnomaly AS DOUBLE)) AS AnomalyRate, avg(ExcessBurn_kg) AS MeanExcessBurn
               FROM ({_ff_sql()}) WHERE ScheduledRoute IS NOT NULL GROUP BY 1)
    SELECT g.*, 'Route' AS SegmentType, coalesce(AnomalyRate > (SELECT quantile_cont(AnomalyRate, 0.5) FROM g), false) AS PersistenceFlag FROM g
    """,
    "SegmentName, FlightCount, AnomalyCount, AnomalyRate, MeanExcessBurn:d, SegmentType, PersistenceFlag",
)
def fallback_anomaly_monitor(spark, sf):
    """Fallback monitor, persistent above the median route rate."""
    return views.fallback_anomaly_monitor(_ff(spark, sf))


@query(
    "fallback_scenarios",
    f"SELECT 'Route' AS SegmentType, ScheduledRoute AS SegmentName, '{C.SCENARIOS[0][0]}' AS Scenario, "
    f"AnnualAvoidableCost_eur * {C.SCENARIOS[0][1]} AS SavingsPotential_eur, AnnualAvoidableCO2_t * {C.SCENARIOS[0][1]} AS SavingsPotential_CO2_t "
    f"FROM ({_FB_ROUTE_SQL})",
    "SegmentType, SegmentName, Scenario, SavingsPotential_eur:d, SavingsPotential_CO2_t:d",
)
def fallback_scenarios(spark, sf):
    """The 25 % scenario over the fallback route table."""
    return views.fallback_scenarios(views.fallback_route_opportunity(_ff(spark, sf)))


# ---------------------------------------------------------------------------
# ML15 / ML17 / A36 (SQL-checkable)


@query(
    "impute_mode_median",
    """
    SELECT (SELECT quantile_cont(Freight, 0.5) FROM eng) AS FreightMedian,
           count(*) FILTER (WHERE Freight IS NULL) AS FreightImputed,
           (SELECT Carrier FROM eng WHERE Carrier IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, Carrier LIMIT 1) AS CarrierMode,
           sum(coalesce(Freight, (SELECT quantile_cont(Freight, 0.5) FROM eng))) AS FreightFilledSum
    FROM eng
    """,
    "FreightMedian:d, FreightImputed, CarrierMode, FreightFilledSum:d",
)
def impute_mode_median(spark, sf):
    """ML15: median / mode imputation computed from the scoring set itself."""
    e = _eng(spark, sf)
    filled = ml.impute_for_scoring(e, ["Freight"], ["Carrier"])
    from ..functions.quantile import exact_quantiles
    from ..operators.sizing import with_scalars

    med = exact_quantiles(e, "Freight", {"FreightMedian": 0.5})
    mode = e.where(F.col("Carrier").isNotNull()).groupBy("Carrier").agg(F.count(F.lit(1)).alias("_n")).orderBy(
        F.desc("_n"), "Carrier").limit(1).select(F.col("Carrier").alias("CarrierMode"))
    agg = e.agg(F.count_if(F.col("Freight").isNull()).alias("FreightImputed"))
    tot = filled.agg(F.sum("Freight").alias("FreightFilledSum"))
    return with_scalars(with_scalars(with_scalars(med, agg), mode), tot)


@query(
    "drift_check",
    f"""
    WITH r AS (SELECT PredictedBurn_kg AS raw FROM bench),
    p AS (SELECT raw, CASE WHEN raw < 0 THEN CAST(0.0 AS DOUBLE) ELSE raw END AS prediction FROM r)
    SELECT avg(prediction) AS Mean, stddev_pop(prediction) AS Std, min(prediction) AS Min, max(prediction) AS Max,
           count(*) FILTER (WHERE raw < 0) AS Negatives, count(prediction) AS N,
           quantile_cont(prediction, 0.25) AS P25, quantile_cont(prediction, 0.75) AS P75,
           abs(avg(prediction) - {C.REFERENCE_MEAN_TARGET}) / {C.REFERENCE_MEAN_TARGET} AS DriftRatio,
           abs(avg(prediction) - {C.REFERENCE_MEAN_TARGET}) / {C.REFERENCE_MEAN_TARGET} > {C.DRIFT_TOLERANCE} AS DriftWarning
    FROM p
    """,
    "Mean:d, Std:d, Min:d, Max:d, Negatives, N, P25:d, P75:d, DriftRatio:d, DriftWarning",
)
def drift_check(spark, sf):
    """A36/ML17: prediction summary and the >20 % mean-drift warning."""
    p = predict.with_benchmark(_eng(spark, sf)).select(F.col("PredictedBurn_kg").alias("prediction"))
    return ml.drift_summary(p)


# ---------------------------------------------------------------------------
# ML (rows-only: iterative learners have no SQL twin)

_ML_CACHE: dict = {}


def _data(spark, sf):
    key = (spark.sparkContext.applicationId, sf, "data")
    if key not in _ML_CACHE:
        data = ml.training_frame(_eng(spark, sf))
        _ML_CACHE[key] = (data, data.where(~F.col("IsValidation")), data.where(F.col("IsValidation")))
    return _ML_CACHE[key]


def _model(spark, sf, which: str):
    """Each learner is trained once per session and shared by the queries."""
    key = (spark.sparkContext.applicationId, sf, which)
    if key not in _ML_CACHE:
        _, train, _ = _data(spark, sf)
        _ML_CACHE[key] = {"ridge": lambda: ml.ridge_closed_form_cv(train), "gbt": lambda: ml.boosted_cv(train, "GBT")}[which]()
    return _ML_CACHE[key]


def clear_models() -> None:
    _ML_CACHE.clear()


@query("ridge_cv")
def ridge_cv(spark, sf):
    """ML4/ML8/ML9: ridge alpha search log (alpha, CV RMSE)."""
    rows = [("Ridge Regression", float(p["alpha"]), float(m)) for p, m in _model(spark, sf, "ridge").search]
    return spark.createDataFrame(rows, "Model string, Alpha double, CV_RMSE double")


@query("gbt")
def gbt(spark, sf):
    """ML6: boosted-tree predictions on the validation split."""
    _, _, val = _data(spark, sf)
    return _model(spark, sf, "gbt").model.transform(val).select("OrderKey", "label", "prediction")
