"""Queries of the ranked business, emission, anomaly and story tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import config as C
from ..operators import absorbed, ml, predict, residuals, segments, stats, tables
from .catalog import (
    _MON_SQL,
    _ROUTE_ERR_SQL,
    _ROUTE_OPP_SQL,
    _SCEN_SQL,
    _SEG_OPP_SQL,
    _eng,
    _flights,
    _monitor,
    _resid,
    _route_err,
    _route_opp,
    _seg_opp,
    query,
)


def _top_sql(source: str, n: int, order: str, cols: str, where: str = "true") -> str:
    return f"""
    SELECT CAST(row_number() OVER (ORDER BY {order}) AS INTEGER) AS Rank, {cols}
    FROM (SELECT * FROM ({source}) WHERE {where} ORDER BY {order} LIMIT {n})
    """


@query(
    "opportunity_matrix",
    _top_sql(_ROUTE_OPP_SQL, 100, "round(OpportunityScore, 6) DESC, ScheduledRoute",
             "ScheduledRoute, FlightCount, MeanExcessBurn, AnnualAvoidableCost_eur, OpportunityScore", "FlightCount >= 5"),
    "Rank, ScheduledRoute, FlightCount, MeanExcessBurn:d, AnnualAvoidableCost_eur, OpportunityScore:d",
)
def opportunity_matrix(spark, sf):
    """Opportunity matrix, top 100 routes with at least 5 flights."""
    return tables.opportunity_matrix(_route_opp(spark, sf))


@query(
    "top_segments",
    _top_sql(_SEG_OPP_SQL, 20, "round(AnnualAvoidableCost_eur, 6) DESC, SegmentType, SegmentName",
             "SegmentType, SegmentName, FlightCount, AnnualAvoidableCost_eur", "FlightCount >= 5"),
    "Rank, SegmentType, SegmentName, FlightCount, AnnualAvoidableCost_eur",
)
def top_segments(spark, sf):
    """Top 20 segments by annual avoidable cost."""
    return tables.top_segments(_seg_opp(spark, sf))


@query(
    "top_scenarios",
    _top_sql(_SCEN_SQL, 20, "round(SavingsPotential_eur, 6) DESC, SegmentType, SegmentName, Scenario",
             "SegmentType, SegmentName, Scenario, SavingsPotential_eur, SavingsPotential_CO2_t"),
    "Rank, SegmentType, SegmentName, Scenario, SavingsPotential_eur:d, SavingsPotential_CO2_t:d",
)
def top_scenarios(spark, sf):
    """Top 20 intervention scenarios by savings potential."""
    return tables.top_scenarios(segments.intervention_scenarios(_seg_opp(spark, sf)))


@query(
    "emission_routes",
    _top_sql(_ROUTE_OPP_SQL, 15, "round(AnnualAvoidableCO2_t, 6) DESC, ScheduledRoute",
             "ScheduledRoute, FlightCount, AnnualAvoidableCO2_t, OpportunityScore"),
    "Rank, ScheduledRoute, FlightCount, AnnualAvoidableCO2_t, OpportunityScore:d",
)
def emission_routes(spark, sf):
    """Top 15 routes by annual avoidable CO2."""
    return tables.emission_routes(_route_opp(spark, sf))


@query(
    "emission_hotspots",
    _top_sql(_ROUTE_OPP_SQL, 80, "round(OpportunityScore, 6) DESC, ScheduledRoute",
             "ScheduledRoute, FlightCount, MeanStructuralCO2_kg, MeanAvoidableCO2_kg, OpportunityScore", "FlightCount >= 5"),
    "Rank, ScheduledRoute, FlightCount, MeanStructuralCO2_kg:d, MeanAvoidableCO2_kg:d, OpportunityScore:d",
)
def emission_hotspots(spark, sf):
    """Structural against avoidable CO2, 80 best-scored routes."""
    return tables.emission_hotspots(_route_opp(spark, sf))


@query(
    "recurring_segments",
    _top_sql(_MON_SQL, 20, "round(AnomalyRate, 6) DESC, SegmentType, SegmentName",
             "SegmentType, SegmentName, FlightCount, AnomalyRate, LikelyIssueClass",
             "SegmentType IN ('Route', 'Route × Aircraft') AND FlightCount >= 5"),
    "Rank, SegmentType, SegmentName, FlightCount, AnomalyRate, LikelyIssueClass",
)
def recurring_segments(spark, sf):
    """Top 20 recurring route segments by anomaly rate."""
    return tables.recurring_segments(_monitor(spark, sf))


@query(
    "monitor_order",
    _top_sql(_MON_SQL, 100, "PersistenceFlag DESC, round(AnomalyRate, 6) DESC, FlightCount DESC, SegmentType, SegmentName",
             "SegmentType, SegmentName, PersistenceFlag, AnomalyRate, FlightCount"),
    "Rank, SegmentType, SegmentName, PersistenceFlag, AnomalyRate, FlightCount",
)
def monitor_order(spark, sf):
    """Presentation order of the anomaly monitor, first 100."""
    return tables.monitor_order(_monitor(spark, sf))


@query(
    "worst_routes_focus",
    f"""
    WITH t AS ({_top_sql(_ROUTE_ERR_SQL, 15, "round(RMSE, 6) DESC, ScheduledRoute", "ScheduledRoute, FlightCount, RMSE, FlightCount >= 10 AS Eligible")})
    SELECT *, coalesce(Rank = (SELECT min(Rank) FROM t WHERE Eligible), false) AS IsFocus FROM t
    """,
    "Rank, ScheduledRoute, FlightCount, RMSE:d, Eligible, IsFocus",
)
def worst_routes_focus(spark, sf):
    """15 worst routes by RMSE and the first with at least 10 flights."""
    return tables.worst_routes_focus(_route_err(spark, sf))


@query(
    "passenger_load",
    """
    WITH f AS (SELECT * FROM eng WHERE TotalPassengers > 0),
    q AS (SELECT quantile_cont(LoadFactor, 0.2) AS lo, quantile_cont(LoadFactor, 0.8) AS hi FROM f)
    SELECT corr(LoadFactor, Burnoff) AS Corr, avg(CASE WHEN LoadFactor <= lo THEN Burnoff END) AS MeanLowLoad,
           avg(CASE WHEN LoadFactor >= hi THEN Burnoff END) AS MeanHighLoad, count(*) AS Flights
    FROM f CROSS JOIN q
    """,
    "Corr:d, MeanLowLoad:d, MeanHighLoad:d, Flights",
)
def passenger_load(spark, sf):
    """Load factor against burn over flights with passengers."""
    return tables.passenger_load(_eng(spark, sf))


@query(
    "passenger_bias",
    """
    WITH f AS (SELECT * FROM resid WHERE TotalPassengers > 10 AND LoadFactor IS NOT NULL),
    b AS (
      SELECT Residual, mn, mx, (mx - mn) / 10 AS w,
             CASE WHEN mx - mn = 0 THEN NULL
                  ELSE CAST(least(greatest(ceil((LoadFactor - mn) / ((mx - mn) / 10)), 1), 10) AS INTEGER) END AS Bin
      FROM f CROSS JOIN (SELECT min(LoadFactor) AS mn, max(LoadFactor) AS mx FROM f)
    ), g AS (
      SELECT Bin, first(((CASE WHEN Bin = 1 THEN mn - (mx - mn) * 0.001 ELSE mn + (Bin - 1) * w END) + (mn + Bin * w)) / 2) AS BinMid,
             avg(Residual) AS MeanResidual, count(*) AS Rows
      FROM b GROUP BY Bin
    )
    SELECT *, CASE WHEN MeanResidual > 0 THEN 'Over-predicted' ELSE 'Under-predicted' END AS Direction FROM g
    """,
    "Bin, BinMid:d, MeanResidual:d, Rows, Direction",
)
def passenger_bias(spark, sf):
    """Prediction bias by load bin, flights with more than 10 passengers."""
    return tables.passenger_bias(_resid(spark, sf))


@query(
    "season_spread",
    """
    WITH g AS (
      SELECT Season, count(Burnoff) AS N, quantile_cont(Burnoff, 0.25) AS Q1, quantile_cont(Burnoff, 0.5) AS Median,
             quantile_cont(Burnoff, 0.75) AS Q3, avg(Burnoff) AS Mean
      FROM eng WHERE Season IS NOT NULL GROUP BY 1
    )
    SELECT g.*, Season = (SELECT arg_max(Season, Median) FROM g) AS IsHighest, Season = (SELECT arg_min(Season, Median) FROM g) AS IsLowest,
           (SELECT max(Median) - min(Median) FROM g) AS MedianSpread
    FROM g
    """,
    "Season, N, Q1:d, Median:d, Q3:d, Mean:d, IsHighest, IsLowest, MedianSpread:d",
)
def season_spread(spark, sf):
    """Burn per season with the highest and lowest median and their gap."""
    return tables.season_spread(_eng(spark, sf))


@query(
    "hour_matrix",
    f"""
    WITH c AS (
      SELECT string_split(SegmentName, ' | ')[1] AS Origin, string_split(SegmentName, ' | ')[2] AS HourBand, avg(AnomalyRate * 100) AS RatePct
      FROM ({_SEG_OPP_SQL}) WHERE SegmentType = 'Airport × Hour' GROUP BY 1, 2
    ), b AS (SELECT DISTINCT HourBand FROM c),
    r AS (SELECT Origin, sum(RatePct) / (SELECT count(*) FROM b) AS RowMeanPct FROM c GROUP BY 1),
    t AS (
      SELECT *, CAST(row_number() OVER (ORDER BY round(RowMeanPct, 6) DESC, Origin) AS INTEGER) AS Rank
      FROM (SELECT * FROM r ORDER BY round(RowMeanPct, 6) DESC, Origin LIMIT 15)
    ), l AS (
      SELECT t.Rank, t.Origin, t.RowMeanPct, b.HourBand, coalesce(c.RatePct, 0.0) AS RatePct
      FROM t CROSS JOIN b LEFT JOIN c ON c.Origin = t.Origin AND c.HourBand = b.HourBand
    )
    SELECT *, row_number() OVER (ORDER BY round(RatePct, 6) DESC, Rank, HourBand) = 1 AS IsHottest FROM l
    """,
    "Rank, Origin, RowMeanPct:d, HourBand, RatePct:d, IsHottest",
)
def hour_matrix(spark, sf):
    """The airport x hour matrix with its hottest cell."""
    return tables.hour_matrix(_seg_opp(spark, sf))


@query(
    "anomaly_kpis",
    f"""
    SELECT count(*) FILTER (WHERE IsAnomaly) AS Anomalies, avg(CASE WHEN IsAnomaly THEN 1.0 ELSE 0.0 END) * 100 AS AnomalyPct,
           count(*) FILTER (WHERE IsOverburnAnomaly) AS OverburnAnomalies, count(*) FILTER (WHERE IsUnderburnAnomaly) AS UnderburnAnomalies,
           (SELECT count(*) FILTER (WHERE PersistenceFlag) FROM ({_MON_SQL})) AS PersistentSegments
    FROM flights
    """,
    "Anomalies, AnomalyPct:d, OverburnAnomalies, UnderburnAnomalies, PersistentSegments",
)
def anomaly_kpis(spark, sf):
    """Flagged flights, their share and direction, persistent segments."""
    return tables.anomaly_kpis(_flights(spark, sf), _monitor(spark, sf))


_TEXT_METRICS = ("MeanBurnoff", "RMSE", "MAPE", "MeanTripTime", "MeanLoadFactor", "MeanDistKm")


@query(
    "metric_text",
    f"""
    WITH r AS (SELECT * FROM ({_ROUTE_ERR_SQL}) ORDER BY FlightCount DESC, ScheduledRoute LIMIT 20),
    l AS ({' UNION ALL '.join(f"SELECT ScheduledRoute, '{'MeanDistanceKm' if m == 'MeanDistKm' else m}' AS Metric, {m} AS v FROM r" for m in _TEXT_METRICS)})
    SELECT ScheduledRoute, Metric,
           CASE WHEN v IS NULL OR isnan(v) THEN 'n/a'
                WHEN Metric IN ('MAPE', 'MeanLoadFactor') THEN format('{{:.1f}}%', v * 100)
                ELSE trim(format('{{:,.1f}}', v) || ' ' || CASE Metric WHEN 'MeanBurnoff' THEN 'kg' WHEN 'RMSE' THEN 'kg'
                     WHEN 'MeanTripTime' THEN 'sec' WHEN 'MeanDistanceKm' THEN 'km' ELSE '' END) END AS Label
    FROM l
    """,
    "ScheduledRoute, Metric, Label",
)
def metric_text(spark, sf):
    """Map metrics of the 20 busiest routes as text with units."""
    top = _route_err(spark, sf).orderBy(F.desc("FlightCount"), "ScheduledRoute").limit(20).withColumnRenamed("MeanDistKm", "MeanDistanceKm")
    names = ["MeanDistanceKm" if m == "MeanDistKm" else m for m in _TEXT_METRICS]
    long = top.unpivot(["ScheduledRoute"], names, "Metric", "_v")
    return long.select("ScheduledRoute", "Metric", tables.metric_text(F.col("Metric"), F.col("_v")).alias("Label"))


@query(
    "shared_models",
    "SELECT 'GroupMean' AS Model FROM bench WHERE PredictedBurn_kg IS NOT NULL GROUP BY 1 "
    "UNION SELECT 'Naive baseline' FROM bench WHERE BaselinePred_kg IS NOT NULL GROUP BY 1",
    "Model",
)
def shared_models(spark, sf):
    """Models present both in the metrics table and as predictions."""
    b = predict.with_benchmark(_eng(spark, sf))
    preds = {"GroupMean": "PredictedBurn_kg", "Naive baseline": "BaselinePred_kg"}
    results = residuals.metrics_long(b, C.TARGET, {**preds, "Unscored": "BaselinePred_kg"}).withColumnRenamed("Label", "Model")
    long = b.select(F.explode(F.array(*[F.struct(F.lit(k).alias("Model"), F.col(c).alias("yhat")) for k, c in preds.items()])).alias("p"))
    return tables.shared_models(results, long.where("p.yhat IS NOT NULL").select("p.Model"))


_VIF_COLUMNS = ["PlannedTripTime", "LoadFactor", "WeightDelta"]


def _vif3_sql(cols: list[str]) -> str:
    """Uncentred VIFs of three columns in closed form: G_ii times the cofactor over the determinant."""
    sums = ", ".join(f"sum(x{i} * x{j}) AS g{i}{j}" for i in range(3) for j in range(i, 3))
    cofactor = ["g11 * g22 - g12 * g12", "g00 * g22 - g02 * g02", "g00 * g11 - g01 * g01"]
    det = "(g00 * (g11 * g22 - g12 * g12) - g01 * (g01 * g22 - g12 * g02) + g02 * (g01 * g12 - g11 * g02))"
    some = " AND ".join(f"{c} IS NOT NULL" for c in cols)
    rows = " UNION ALL ".join(f"SELECT '{c}' AS Feature, g{i}{i} * ({cofactor[i]}) / {det} AS VIF FROM g" for i, c in enumerate(cols))
    columns = ", ".join(f"CAST({c} AS DOUBLE) AS x{i}" for i, c in enumerate(cols))
    return f"""
    WITH x AS (SELECT {columns} FROM eng WHERE {some}), g AS (SELECT {sums} FROM x)
    SELECT *, CASE WHEN VIF > 10 THEN 'high' WHEN VIF > 5 THEN 'moderate' ELSE 'low' END AS Level FROM ({rows})
    """


@query("vif_three", _vif3_sql(_VIF_COLUMNS), "Feature, VIF:d, Level")
def vif_three(spark, sf):
    """L3: variance inflation of three columns, against the closed form."""
    return stats.vif(_eng(spark, sf), _VIF_COLUMNS)


_RIDGE_FEATURE = "PlannedTripTime"
_RIDGE_ROWS = " AND ".join(f"{c} IS NOT NULL" for c in [*C.NUMERIC_FEATURES, *C.CATEGORICAL_FEATURES, C.TARGET])


@query(
    "ridge_one_feature",
    f"""
    WITH t AS (SELECT Fold, CAST({_RIDGE_FEATURE} AS DOUBLE) AS x, Burnoff AS y FROM splitf WHERE NOT IsValidation AND {_RIDGE_ROWS}),
    f AS (SELECT DISTINCT Fold AS k FROM t),
    s AS (SELECT k, avg(x) AS mu, stddev_pop(x) AS sd, avg(y) AS yb FROM f JOIN t ON t.Fold <> f.k GROUP BY k),
    c AS (SELECT s.k, sum((x - mu) / sd * (y - yb)) AS zy, sum((x - mu) / sd * ((x - mu) / sd)) AS zz FROM s JOIN t ON t.Fold <> s.k GROUP BY s.k),
    a AS (SELECT unnest([{', '.join(str(float(a)) for a in C.RIDGE_ALPHAS)}]) AS Alpha),
    r AS (
      SELECT a.Alpha, s.k, sqrt(avg((s.yb + c.zy / (c.zz + a.Alpha) * (t.x - s.mu) / s.sd - t.y) * (s.yb + c.zy / (c.zz + a.Alpha) * (t.x - s.mu) / s.sd - t.y))) AS rmse
      FROM a CROSS JOIN s JOIN c ON c.k = s.k JOIN t ON t.Fold = s.k GROUP BY a.Alpha, s.k
    )
    SELECT CAST(Alpha AS DOUBLE) AS Alpha, avg(rmse) AS CV_RMSE FROM r GROUP BY 1
    """,
    "Alpha:d, CV_RMSE:d",
)
def ridge_one_feature(spark, sf):
    """ML4: the ridge search on one feature, against the closed form per fold."""
    data = ml.training_frame(_eng(spark, sf)).where(~F.col("IsValidation"))
    fitted = ml.ridge_closed_form_cv(data, numeric=[_RIDGE_FEATURE], categorical=[])
    return spark.createDataFrame([(float(p["alpha"]), float(r)) for p, r in fitted.search], "Alpha double, CV_RMSE double")


@query(
    "ridge_route_effects",
    f"""
    WITH t AS (SELECT ScheduledRoute AS l, CAST({_RIDGE_FEATURE} AS DOUBLE) AS x, Burnoff AS y FROM splitf WHERE NOT IsValidation AND {_RIDGE_ROWS}),
    m AS (SELECT avg(x) AS mu, stddev_pop(x) AS sd, avg(y) AS yb FROM t),
    z AS (SELECT l, (x - mu) / sd AS z, y - yb AS y FROM t, m),
    lev AS (SELECT l, CAST(count(*) AS DOUBLE) AS n, sum(z) AS s, sum(y) AS t FROM z WHERE l IS NOT NULL GROUP BY l),
    g AS (SELECT count(*) AS n, sum(z) AS s, sum(z * z) AS zz, sum(y) AS t, sum(z * y) AS zy FROM z),
    r AS (SELECT sum(n * n / (n + 1)) AS n, sum(n * s / (n + 1)) AS s, sum(s * s / (n + 1)) AS zz, sum(n * t / (n + 1)) AS t, sum(s * t / (n + 1)) AS zy FROM lev),
    a AS (SELECT g.n - r.n AS p, g.s - r.s AS q, g.zz - r.zz + 1 AS u, g.t - r.t AS b0, g.zy - r.zy AS b1 FROM g, r),
    w AS (SELECT (p * b1 - q * b0) / (p * u - q * q) AS w, p, q, b0 FROM a),
    f AS (SELECT w, (b0 - q * w) / p AS b FROM w)
    SELECT l AS ScheduledRoute, (t - n * b - s * w) / (n + 1) AS Effect FROM lev, f
    """,
    "ScheduledRoute, Effect:d",
)
def ridge_route_effects(spark, sf):
    """ML2/ML4: effect of every route beside one feature, the routes eliminated by group sums."""
    return _absorbed(spark, sf, [_RIDGE_FEATURE], [1.0]).effects


@query("ridge_route_search")
def ridge_route_search(spark, sf):
    """ML4/ML8: the ridge search over all numerics and the routes as levels."""
    search = _absorbed(spark, sf, C.NUMERIC_FEATURES, C.RIDGE_ALPHAS).search
    return spark.createDataFrame(search, "Alpha double, CV_RMSE double")


def _absorbed(spark, sf, numeric, alphas):
    data = ml.training_frame(_eng(spark, sf)).where(~F.col("IsValidation"))
    return absorbed.absorbed_ridge_cv(data, numeric, "ScheduledRoute", alphas)


@query(
    "distance_error",
    """
    WITH r AS (SELECT AbsError, RouteDistanceKm FROM resid WHERE AbsError <= (SELECT quantile_cont(AbsError, 0.99) FROM resid)),
    q AS (SELECT quantile_cont(RouteDistanceKm, 0.25) AS lo, quantile_cont(RouteDistanceKm, 0.75) AS hi FROM r)
    SELECT count(*) AS Rows, regr_slope(AbsError, RouteDistanceKm) AS SlopePerKm, avg(AbsError) FILTER (WHERE RouteDistanceKm <= lo) AS ShortMean,
           avg(AbsError) FILTER (WHERE RouteDistanceKm >= hi) AS LongMean,
           avg(AbsError) FILTER (WHERE RouteDistanceKm >= hi) - avg(AbsError) FILTER (WHERE RouteDistanceKm <= lo) AS LongMinusShort
    FROM r, q
    """,
    "Rows, SlopePerKm:d, ShortMean:d, LongMean:d, LongMinusShort:d",
)
def distance_error(spark, sf):
    """Error against distance, the largest 1 % of errors left out."""
    return tables.distance_error(_resid(spark, sf))
