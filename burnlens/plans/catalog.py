"""Registered queries: name -> (Spark plan, DuckDB oracle).

Each Spark callable takes ``(spark, sf_dir)`` and returns a DataFrame built
from the driver tables (through the written stage tables of
``plans.stages``). Each oracle is ``BASE`` (the same stages in SQL) plus a
body. Row values, counts' shares and totals of money, CO2 and fuel (``S.fixed_sum``)
don't depend on the order of the rows and are returned in full. Means, deviations
and what is computed from them or by trigonometry do: columns marked ``:d`` are
rounded to 9 significant digits on both sides (``sig_round`` / ``sr``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..functions import scalar as S
from ..operators import features, predict, residuals, segments, stats, value, views
from . import stages
from .oracle_base import BASE, fsum, sr, wrap

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def finalize(df: DataFrame, rounded: set[str]) -> DataFrame:
    """Round the ``rounded`` columns to 9 significant digits, as ``S.sig_round`` does;
    a value's exponent and power of ten are columns of their own, computed once."""
    names = [c for c in df.columns if c in rounded]
    if not names:
        return df
    at = {c: i for i, c in enumerate(names)}
    out = df.select("*", *[S.sig_exponent(F.col(f"`{c}`")).alias(f"_exponent{i}") for c, i in at.items()])
    out = out.select("*", *[F.pow(F.lit(10.0), F.abs(f"_exponent{i}")).alias(f"_unit{i}") for i in at.values()])
    return out.select(*[
        S.sig_rounded(F.col(f"`{c}`"), F.col(f"_exponent{at[c]}"), F.col(f"_unit{at[c]}")).alias(c) if c in at else F.col(f"`{c}`")
        for c in df.columns
    ])


def query(name: str, sql_body: str | None = None, cols: str | None = None):
    def deco(fn):
        rounded = {c.strip()[:-2] for c in (cols or "").split(",") if c.strip().endswith(":d")}
        QUERIES[name] = lambda spark, sf_dir: finalize(fn(spark, sf_dir), rounded)
        QUERIES[name].__doc__ = fn.__doc__
        if sql_body is not None:
            ORACLES[name] = BASE + wrap(sql_body, cols)
        return fn

    return deco


def _eng(spark, sf):
    return stages.engineered(spark, sf)


def _flights(spark, sf):
    return stages.scored(spark, sf)


def _resid(spark, sf):
    return residuals.residuals(predict.with_benchmark(_eng(spark, sf)))


def _airports(spark, sf):
    return stages.airports(spark, sf)


# ---------------------------------------------------------------------------
# Stage 1: features


@query(
    "feat_time",
    "SELECT OrderKey, DepartureHour, DepartureMonth, DepartureYear, DepartureDayOfWeek, Season FROM eng",
    "OrderKey, DepartureHour, DepartureMonth, DepartureYear, DepartureDayOfWeek, Season",
)
def feat_time(spark, sf):
    """M2/M3 time features over every engineered row."""
    return _eng(spark, sf).select("OrderKey", "DepartureHour", "DepartureMonth", "DepartureYear", "DepartureDayOfWeek", "Season")


@query(
    "feat_route_distance",
    "SELECT OrderKey, ScheduledRoute, Origin, Destination, RouteDistanceKm, DistanceImputed FROM eng",
    "OrderKey, ScheduledRoute, Origin, Destination, RouteDistanceKm:d, DistanceImputed",
)
def feat_route_distance(spark, sf):
    """Route split, great-circle distance, block-time fallback."""
    return _eng(spark, sf).select("OrderKey", "ScheduledRoute", "Origin", "Destination", "RouteDistanceKm", "DistanceImputed")


@query(
    "feat_load",
    "SELECT OrderKey, TotalPassengers, AircraftCapacity, LoadFactor, Freight, FreightPerKg, WeightDelta, BaselineDelta FROM eng",
    "OrderKey, TotalPassengers, AircraftCapacity, LoadFactor, Freight, FreightPerKg, WeightDelta, BaselineDelta",
)
def feat_load(spark, sf):
    """Passengers, clipped load factor, freight fill, weight deltas."""
    return _eng(spark, sf).select(
        "OrderKey", "TotalPassengers", "AircraftCapacity", "LoadFactor", "Freight", "FreightPerKg", "WeightDelta", "BaselineDelta"
    )


@query(
    "feat_type_factor",
    "SELECT OrderKey, AircraftTypeGroup, TypeWeightInteraction, TypeTripTimeInteraction FROM eng",
    "OrderKey, AircraftTypeGroup, TypeWeightInteraction, TypeTripTimeInteraction",
)
def feat_type_factor(spark, sf):
    """Type multiplier times TOW and trip time."""
    return _eng(spark, sf).select("OrderKey", "AircraftTypeGroup", "TypeWeightInteraction", "TypeTripTimeInteraction")


@query(
    "feat_burn_rate",
    "SELECT OrderKey, Burnoff, PlannedTripTime, BurnoffPerMinute FROM eng",
    "OrderKey, Burnoff, PlannedTripTime, BurnoffPerMinute",
)
def feat_burn_rate(spark, sf):
    """Burn per planned minute."""
    return _eng(spark, sf).select("OrderKey", "Burnoff", "PlannedTripTime", "BurnoffPerMinute")


@query(
    "positive_filter",
    "SELECT count(*) AS RowsIn, count(*) FILTER (WHERE Burnoff > 0) AS RowsKept, "
    "count(*) - count(*) FILTER (WHERE Burnoff > 0) AS RowsDropped FROM raw",
    "RowsIn, RowsKept, RowsDropped",
)
def positive_filter(spark, sf):
    """Rows in, kept (target > 0) and dropped, in one pass."""
    from ..sources import bind

    raw = bind.raw_fact(spark, sf)
    return raw.agg(
        F.count(F.lit(1)).alias("RowsIn"),
        F.count_if(F.col(C.TARGET) > 0).alias("RowsKept"),
    ).withColumn("RowsDropped", F.col("RowsIn") - F.col("RowsKept"))


_ALL_FEATS = C.NUMERIC_FEATURES + C.CATEGORICAL_FEATURES + [C.TARGET]


@query(
    "dropna_features",
    "SELECT count(*) AS RowsIn, count(*) FILTER (WHERE "
    + " AND ".join(f"{c} IS NOT NULL" for c in _ALL_FEATS)
    + ") AS RowsComplete FROM eng",
    "RowsIn, RowsComplete",
)
def dropna_features(spark, sf):
    """Rows left after dropping any NULL among model features + target."""
    e = _eng(spark, sf)
    complete = None
    for c in _ALL_FEATS:
        cond = F.col(c).isNotNull()
        complete = cond if complete is None else complete & cond
    return e.agg(F.count(F.lit(1)).alias("RowsIn"), F.count_if(complete).alias("RowsComplete"))


@query(
    "route_summary",
    """
    SELECT g.*, string_split(g.ScheduledRoute, '-')[1] AS Origin, string_split(g.ScheduledRoute, '-')[2] AS Destination,
           o.lat AS OrgLat, o.lon AS OrgLon, coalesce(o.city, string_split(g.ScheduledRoute, '-')[1]) AS OrgCity,
           coalesce(o.country, '') AS OrgCountry,
           d.lat AS DstLat, d.lon AS DstLon, coalesce(d.city, string_split(g.ScheduledRoute, '-')[2]) AS DstCity,
           coalesce(d.country, '') AS DstCountry
    FROM (SELECT ScheduledRoute, count(Burnoff) AS FlightCount, avg(Burnoff) AS MeanBurnoff,
                 quantile_cont(Burnoff, 0.5) AS MedianBurnoff, stddev_samp(Burnoff) AS StdBurnoff,
                 avg(PlannedTOW) AS MeanTOW, avg(PlannedTripTime) AS MeanTripTime,
                 avg(LoadFactor) AS MeanLoadFactor, avg(RouteDistanceKm) AS MeanDistanceKm
          FROM eng WHERE ScheduledRoute IS NOT NULL GROUP BY 1) g
    LEFT JOIN airports o ON upper(string_split(g.ScheduledRoute, '-')[1]) = o.iata
    LEFT JOIN airports d ON upper(string_split(g.ScheduledRoute, '-')[2]) = d.iata
    """,
    "ScheduledRoute, FlightCount, MeanBurnoff:d, MedianBurnoff:d, StdBurnoff:d, MeanTOW:d, MeanTripTime:d, "
    "MeanLoadFactor:d, MeanDistanceKm:d, Origin, Destination, OrgLat, OrgLon, OrgCity, OrgCountry, "
    "DstLat, DstLon, DstCity, DstCountry",
)
def route_summary(spark, sf):
    """Route EDA table with both ends' location."""
    return features.route_summary(_eng(spark, sf), _airports(spark, sf))


# ---------------------------------------------------------------------------
# Stage 2/3: benchmark prediction, residuals, metrics


@query(
    "hash_split",
    "SELECT IsValidation, Fold, count(*) AS Rows, avg(Burnoff) AS MeanBurnoff FROM splitf GROUP BY 1, 2",
    "IsValidation, Fold, Rows, MeanBurnoff:d",
)
def hash_split(spark, sf):
    """ML1/ML3: md5 split of every row into train / validation and 5 folds."""
    s = predict.hash_split(_eng(spark, sf))
    return s.groupBy("IsValidation", "Fold").agg(F.count(F.lit(1)).alias("Rows"), F.avg(C.TARGET).alias("MeanBurnoff"))


@query(
    "baseline_by_group",
    "SELECT m.AircraftTypeGroup, m.PredictedBurn_kg AS TrainMean, b.BaselinePred_kg AS OverallMean "
    "FROM gm_model m JOIN gm_base b ON m.AircraftTypeGroup = b.AircraftTypeGroup",
    "AircraftTypeGroup, TrainMean, OverallMean",
)
def baseline_by_group(spark, sf):
    """Mean target per aircraft type on the training split and overall."""
    s = predict.hash_split(_eng(spark, sf))
    m = predict.group_mean_model(s.where(~F.col("IsValidation")), name="TrainMean")
    b = predict.group_mean_model(s, name="OverallMean")
    return m.join(b, "AircraftTypeGroup")


@query(
    "residuals",
    "SELECT OrderKey, Burnoff, PredictedBurn_kg, Residual, AbsError, RelError, Excess AS ExcessBurn_kg, ExcessBurnPct FROM resid",
    "OrderKey, Burnoff, PredictedBurn_kg, Residual, AbsError, RelError, ExcessBurn_kg, ExcessBurnPct",
)
def residuals_q(spark, sf):
    """M20 over every row: residual, abs / relative error, excess, excess %."""
    return _resid(spark, sf).select(
        "OrderKey", "Burnoff", "PredictedBurn_kg", "Residual", "AbsError", "RelError", "ExcessBurn_kg", "ExcessBurnPct"
    )


def _metric_sql(y: str, yhat: str) -> str:
    e = f"({yhat} - {y})"
    return (
        f"round_even(sqrt(avg({e} * {e})), 2) AS RMSE, round_even(avg(abs({e})), 2) AS MAE, "
        f"round_even(avg(abs({e}) / greatest(abs({y}), CAST(2.220446049250313e-16 AS DOUBLE))) * 100, 3) AS MAPE, "
        f"round_even(1.0 - sum({e} * {e}) / (sum({y} * {y}) - pow(sum({y}), 2) / count({y})), 4) AS R2"
    )


@query(
    "model_metrics",
    f"SELECT IsValidation, {_metric_sql('Burnoff', 'PredictedBurn_kg')} FROM bench "
    "WHERE PredictedBurn_kg IS NOT NULL AND Burnoff IS NOT NULL GROUP BY 1",
    "IsValidation, RMSE:d, MAE:d, MAPE:d, R2:d",
)
def model_metrics(spark, sf):
    """RMSE / MAE / MAPE / R^2 of the benchmark model, per split side."""
    d = predict.with_benchmark(_eng(spark, sf)).where(F.col("PredictedBurn_kg").isNotNull() & F.col(C.TARGET).isNotNull())
    m = d.groupBy("IsValidation").agg(*residuals.metric_exprs(C.TARGET, "PredictedBurn_kg"))
    return m.select(
        "IsValidation", F.bround("RMSE", 2).alias("RMSE"), F.bround("MAE", 2).alias("MAE"),
        F.bround("MAPE", 3).alias("MAPE"), F.bround("R2", 4).alias("R2"),
    )


@query(
    "baseline_vs_model",
    """
    SELECT Label, round_even(sqrt(avg((yhat - y) * (yhat - y))), 2) AS RMSE,
           round_even(avg(abs(yhat - y) / greatest(abs(y), CAST(2.220446049250313e-16 AS DOUBLE))) * 100, 3) AS MAPE,
           round_even(1.0 - sum((yhat - y) * (yhat - y)) / (sum(y * y) - pow(sum(y), 2) / count(y)), 4) AS R2
    FROM (SELECT 'Naive baseline (mean/type)' AS Label, Burnoff AS y, BaselinePred_kg AS yhat FROM bench
          UNION ALL SELECT 'GroupMean', Burnoff, PredictedBurn_kg FROM bench)
    WHERE y IS NOT NULL AND yhat IS NOT NULL GROUP BY 1
    """,
    "Label, RMSE:d, MAPE:d, R2:d",
)
def baseline_vs_model(spark, sf):
    """Baseline vs model metrics from a long (label, y, yhat) stack."""
    b = predict.with_benchmark(_eng(spark, sf))
    return residuals.metrics_long(b, C.TARGET, {"Naive baseline (mean/type)": "BaselinePred_kg", "GroupMean": "PredictedBurn_kg"})


@query(
    "within_tolerance",
    "SELECT avg(CASE WHEN abs(PredictedBurn_kg - Burnoff) / greatest(abs(Burnoff), 1.0) <= 0.05 THEN 1.0 ELSE 0.0 END) AS WithinTolShare, "
    "avg(PredictedBurn_kg - Burnoff) AS MeanBias, count(*) AS Rows FROM bench",
    "WithinTolShare, MeanBias:d, Rows",
)
def within_tolerance(spark, sf):
    """Share within 5 % relative error (actual floored at 1), and mean bias."""
    return residuals.within_tolerance(predict.with_benchmark(_eng(spark, sf)), C.TARGET, "PredictedBurn_kg")


_ROUTE_ERR_SQL = """
    SELECT g.*, string_split(g.ScheduledRoute, '-')[1] AS Origin, string_split(g.ScheduledRoute, '-')[2] AS Destination,
           o.lat AS OrgLat, o.lon AS OrgLon, coalesce(o.city, string_split(g.ScheduledRoute, '-')[1]) AS OrgCity,
           d.lat AS DstLat, d.lon AS DstLon, coalesce(d.city, string_split(g.ScheduledRoute, '-')[2]) AS DstCity
    FROM (SELECT ScheduledRoute, count(Burnoff) AS FlightCount, avg(Burnoff) AS MeanBurnoff, avg(PredictedBurn_kg) AS MeanPred,
                 sqrt(avg(Residual * Residual)) AS RMSE, avg(RelError) AS MAPE, avg(AbsError) AS MeanAbsError,
                 avg(PlannedTripTime) AS MeanTripTime, avg(LoadFactor) AS MeanLoadFactor, avg(RouteDistanceKm) AS MeanDistKm
          FROM resid WHERE ScheduledRoute IS NOT NULL GROUP BY 1) g
    LEFT JOIN airports o ON upper(string_split(g.ScheduledRoute, '-')[1]) = o.iata
    LEFT JOIN airports d ON upper(string_split(g.ScheduledRoute, '-')[2]) = d.iata
    WHERE o.lat IS NOT NULL AND o.lon IS NOT NULL
"""
_ROUTE_ERR_COLS = (
    "ScheduledRoute, FlightCount, MeanBurnoff:d, MeanPred:d, RMSE:d, MAPE:d, MeanAbsError:d, MeanTripTime:d, "
    "MeanLoadFactor:d, MeanDistKm:d, Origin, Destination, OrgLat, OrgLon, OrgCity, DstLat, DstLon, DstCity"
)


def _route_err(spark, sf):
    return residuals.route_error(_resid(spark, sf), _airports(spark, sf))


@query("route_error", _ROUTE_ERR_SQL, _ROUTE_ERR_COLS)
def route_error(spark, sf):
    """Per-route error with geography (known origins only)."""
    return _route_err(spark, sf)


@query(
    "worst_routes",
    f"SELECT ScheduledRoute, FlightCount, RMSE, MAPE, MeanBurnoff FROM ({_ROUTE_ERR_SQL}) ORDER BY RMSE DESC, ScheduledRoute LIMIT 10",
    "ScheduledRoute, FlightCount, RMSE:d, MAPE:d, MeanBurnoff:d",
)
def worst_routes(spark, sf):
    """The 10 routes with the highest RMSE."""
    return residuals.worst_routes(_route_err(spark, sf), 10)


@query(
    "bias_report",
    """
    SELECT 'aircraft_type' AS "Group", CAST(AircraftTypeGroup AS VARCHAR) AS "Key", round_even(avg(Residual), 2) AS mean,
           round_even(stddev_samp(Residual), 2) AS std FROM resid WHERE AircraftTypeGroup IS NOT NULL GROUP BY 2
    UNION ALL
    SELECT 'season', CAST(Season AS VARCHAR), round_even(avg(Residual), 2), round_even(stddev_samp(Residual), 2)
    FROM resid WHERE Season IS NOT NULL GROUP BY 2
    UNION ALL
    SELECT 'year', CAST(DepartureYear AS VARCHAR), round_even(avg(Residual), 2), round_even(stddev_samp(Residual), 2)
    FROM resid WHERE DepartureYear IS NOT NULL GROUP BY 2
    """,
    "Group, Key, mean:d, std:d",
)
def bias_report(spark, sf):
    """Residual mean / std per type, season and year (grouping sets)."""
    return residuals.bias_report(_resid(spark, sf))


@query(
    "bias_by_bin",
    """
    WITH b AS (
      SELECT Residual, LoadFactor, mn, mx, (mx - mn) / 10 AS w,
             CASE WHEN mx - mn = 0 THEN NULL
                  ELSE CAST(least(greatest(ceil((LoadFactor - mn) / ((mx - mn) / 10)), 1), 10) AS INTEGER) END AS Bin
      FROM resid CROSS JOIN (SELECT min(LoadFactor) AS mn, max(LoadFactor) AS mx FROM resid WHERE LoadFactor IS NOT NULL)
      WHERE LoadFactor IS NOT NULL
    )
    SELECT Bin,
           first(((CASE WHEN Bin = 1 THEN mn - (mx - mn) * 0.001 ELSE mn + (Bin - 1) * w END) + (mn + Bin * w)) / 2) AS BinMid,
           avg(Residual) AS MeanResidual, count(*) AS Rows
    FROM b GROUP BY Bin
    """,
    "Bin, BinMid:d, MeanResidual:d, Rows",
)
def bias_by_bin(spark, sf):
    """A4/M8: mean residual per 10 equal-width load-factor bins."""
    return residuals.bias_by_bin(_resid(spark, sf), "LoadFactor", "Residual", 10)


@query(
    "monthly_drift",
    "SELECT strftime(DepartureScheduled, '%Y-%m') AS Month, avg(Residual) AS MeanResidual, count(*) AS Rows FROM resid GROUP BY 1",
    "Month, MeanResidual:d, Rows",
)
def monthly_drift(spark, sf):
    """A5: mean residual per calendar month."""
    return residuals.monthly_drift(_resid(spark, sf))


@query(
    "monthly_volume",
    """
    WITH v AS (SELECT strftime(DepartureScheduled, '%Y-%m') AS Month, count(*) AS Flights FROM eng GROUP BY 1)
    SELECT v.*, p.PeakMonth, p.PeakFlights, p.TroughMonth, p.TroughFlights,
           CAST(p.PeakFlights AS DOUBLE) / p.TroughFlights AS PeakTroughRatio
    FROM v CROSS JOIN (
      SELECT arg_max(Month, Flights * 100000000 - CAST(replace(Month, '-', '') AS BIGINT)) AS PeakMonth, max(Flights) AS PeakFlights,
             arg_min(Month, Flights * 100000000 + CAST(replace(Month, '-', '') AS BIGINT)) AS TroughMonth, min(Flights) AS TroughFlights
      FROM v) p
    """,
    "Month, Flights, PeakMonth, PeakFlights, TroughMonth, TroughFlights, PeakTroughRatio",
)
def monthly_volume(spark, sf):
    """Flights per month; peak / trough month (earliest on ties, like idxmax) and ratio."""
    return residuals.monthly_volume(_eng(spark, sf))


@query(
    "mae_by_type",
    """
    SELECT AircraftTypeGroup, avg(AbsError) AS MeanAbsError, count(AbsError) AS Rows, stddev_samp(Residual) AS StdResid,
           avg(AbsError) - 1.96 * stddev_samp(AbsError) / sqrt(count(AbsError)) AS CILow,
           avg(AbsError) + 1.96 * stddev_samp(AbsError) / sqrt(count(AbsError)) AS CIHigh
    FROM resid WHERE AircraftTypeGroup IS NOT NULL GROUP BY 1
    """,
    "AircraftTypeGroup, MeanAbsError:d, Rows, StdResid:d, CILow:d, CIHigh:d",
)
def mae_by_type(spark, sf):
    """MAE, n, std and a normal 95 % interval per aircraft type."""
    return residuals.error_by_group(_resid(spark, sf), "AircraftTypeGroup")


@query(
    "mae_by_season",
    """
    SELECT Season, avg(AbsError) AS MeanAbsError, count(AbsError) AS Rows, stddev_samp(Residual) AS StdResid,
           avg(AbsError) - 1.96 * stddev_samp(AbsError) / sqrt(count(AbsError)) AS CILow,
           avg(AbsError) + 1.96 * stddev_samp(AbsError) / sqrt(count(AbsError)) AS CIHigh,
           CASE Season WHEN 'Winter' THEN 0 WHEN 'Spring' THEN 1 WHEN 'Summer' THEN 2 WHEN 'Fall' THEN 3 END AS SeasonOrder
    FROM resid WHERE Season IS NOT NULL GROUP BY 1
    """,
    "Season, MeanAbsError:d, Rows, StdResid:d, CILow:d, CIHigh:d, SeasonOrder",
)
def mae_by_season(spark, sf):
    """MAE per season with the fixed Winter..Fall order."""
    return residuals.error_by_season(_resid(spark, sf))


@query(
    "mean_ci",
    """
    SELECT Carrier, avg(AbsError) AS MeanAbsError, count(AbsError) AS Rows, stddev_samp(Residual) AS StdResid,
           avg(AbsError) - 1.96 * stddev_samp(AbsError) / sqrt(count(AbsError)) AS CILow,
           avg(AbsError) + 1.96 * stddev_samp(AbsError) / sqrt(count(AbsError)) AS CIHigh
    FROM resid WHERE Carrier IS NOT NULL GROUP BY 1
    """,
    "Carrier, MeanAbsError:d, Rows, StdResid:d, CILow:d, CIHigh:d",
)
def mean_ci(spark, sf):
    """Mean with a 95 % interval per carrier."""
    return residuals.error_by_group(_resid(spark, sf), "Carrier")


@query(
    "residual_diagnostics",
    """
    SELECT ScheduledRoute, Carrier, AOCDescription, AircraftTypeGroup, Origin, Destination, Season, DepartureYear,
           DepartureMonth, DepartureHour, Burnoff, PredictedBurn_kg AS y_pred_primary, BaselinePred_kg AS Baseline_pred,
           Residual, AbsError, RelError, Excess AS ExcessBurn_kg, ExcessBurnPct, RouteDistanceKm, LoadFactor,
           TotalPassengers, PlannedTripTime, PlannedTOW, PlannedZeroFuelWeight, TeledyneRampWeight
    FROM resid
    """,
    "ScheduledRoute, Carrier, AOCDescription, AircraftTypeGroup, Origin, Destination, Season, DepartureYear, "
    "DepartureMonth, DepartureHour, Burnoff, y_pred_primary, Baseline_pred, Residual, AbsError, RelError, "
    "ExcessBurn_kg, ExcessBurnPct, RouteDistanceKm:d, LoadFactor, TotalPassengers, PlannedTripTime, "
    "PlannedTOW, PlannedZeroFuelWeight, TeledyneRampWeight",
)
def residual_diagnostics(spark, sf):
    """The 25-column validation-diagnostics projection."""
    return residuals.residual_diagnostics(predict.with_benchmark(_eng(spark, sf)))


# ---------------------------------------------------------------------------
# Stage 6: flight layer


@query(
    "emissions_cost",
    """
    SELECT OrderKey, ExcessBurnPct_pred, ExcessBurnPct_actual, StructuralCO2_kg, ActualCO2_kg, AvoidableCO2_kg,
           AvoidableFuelCost_eur, PlannedFuelProxy_kg, OpsPlanningGap_kg, CarryPenaltyCost_eur FROM f0
    """,
    "OrderKey, ExcessBurnPct_pred, ExcessBurnPct_actual, StructuralCO2_kg, ActualCO2_kg, AvoidableCO2_kg, "
    "AvoidableFuelCost_eur, PlannedFuelProxy_kg, OpsPlanningGap_kg, CarryPenaltyCost_eur",
)
def emissions_cost(spark, sf):
    """CO2, avoidable fuel cost, planning gap and carry penalty."""
    return _flights(spark, sf).select(
        "OrderKey", "ExcessBurnPct_pred", "ExcessBurnPct_actual", "StructuralCO2_kg", "ActualCO2_kg", "AvoidableCO2_kg",
        "AvoidableFuelCost_eur", "PlannedFuelProxy_kg", "OpsPlanningGap_kg", "CarryPenaltyCost_eur",
    )


@query(
    "intensity",
    "SELECT OrderKey, ActualBurnPerKm, PredictedBurnPerKm, IntensityGapPerKm, BurnPerPaxKm_actual, BurnPerPaxKm_pred FROM f0",
    "OrderKey, ActualBurnPerKm:d, PredictedBurnPerKm:d, IntensityGapPerKm:d, BurnPerPaxKm_actual:d, BurnPerPaxKm_pred:d",
)
def intensity(spark, sf):
    """Per-km and per-pax-km (grams) intensities with safe division."""
    return _flights(spark, sf).select(
        "OrderKey", "ActualBurnPerKm", "PredictedBurnPerKm", "IntensityGapPerKm", "BurnPerPaxKm_actual", "BurnPerPaxKm_pred"
    )


@query(
    "bands",
    f"""
    SELECT OrderKey, DepartureHourBand, LoadFactorBand, DistanceBand,
           ScheduledRoute || '{C.SEGMENT_SEP}' || coalesce(CAST(AircraftTypeGroup AS VARCHAR), 'nan') AS RouteAircraft,
           coalesce(CAST(Origin AS VARCHAR), 'nan') || '{C.SEGMENT_SEP}' || DepartureHourBand AS AirportHour
    FROM f0
    """,
    "OrderKey, DepartureHourBand, LoadFactorBand, DistanceBand, RouteAircraft, AirportHour",
)
def bands_q(spark, sf):
    """Hour / load / distance bands and composite keys."""
    return _flights(spark, sf).select("OrderKey", "DepartureHourBand", "LoadFactorBand", "DistanceBand", "RouteAircraft", "AirportHour")


def _cut_sql(x: str, edges, labels) -> str:
    parts = " ".join(
        f"WHEN {x} > {lo} AND {x} <= {hi} THEN '{lab}'"
        for lo, hi, lab in zip(edges[:-1], edges[1:], labels)
        if hi != float("inf")
    )
    last = [(lo, lab) for lo, hi, lab in zip(edges[:-1], edges[1:], labels) if hi == float("inf")]
    if last:
        parts += f" WHEN {x} > {last[0][0]} AND {x} <= CAST('inf' AS DOUBLE) THEN '{last[0][1]}'"
    return f"coalesce(CASE {parts} END, 'nan')"


@query(
    "cut_edges",
    f"""
    SELECT OrderKey, {_cut_sql('DepartureHour', C.FALLBACK_HOUR_EDGES, C.FALLBACK_HOUR_LABELS)} AS HourBandCut,
           {_cut_sql('LoadFactor', C.FALLBACK_LOAD_EDGES, C.FALLBACK_LOAD_LABELS)} AS LoadBandCut,
           {_cut_sql('RouteDistanceKm', C.FALLBACK_DIST_EDGES, C.FALLBACK_DIST_LABELS)} AS DistanceBandCut
    FROM eng
    """,
    "OrderKey, HourBandCut, LoadBandCut, DistanceBandCut",
)
def cut_edges(spark, sf):
    """M9: right-closed explicit-edge bands (the dashboard's pd.cut variant)."""
    e = _eng(spark, sf)
    return e.select(
        "OrderKey",
        F.coalesce(S.cut_edges("DepartureHour", C.FALLBACK_HOUR_EDGES, C.FALLBACK_HOUR_LABELS), F.lit("nan")).alias("HourBandCut"),
        F.coalesce(S.cut_edges("LoadFactor", C.FALLBACK_LOAD_EDGES, C.FALLBACK_LOAD_LABELS), F.lit("nan")).alias("LoadBandCut"),
        F.coalesce(S.cut_edges("RouteDistanceKm", C.FALLBACK_DIST_EDGES, C.FALLBACK_DIST_LABELS), F.lit("nan")).alias("DistanceBandCut"),
    )


@query(
    "segment_zscores",
    "SELECT OrderKey, Residual_kg, ResidualMean_segment, ResidualStd_segment, SegmentBasis, ResidualZ_global, ResidualZ_segment FROM f3",
    "OrderKey, Residual_kg, ResidualMean_segment:d, ResidualStd_segment:d, SegmentBasis, ResidualZ_global:d, ResidualZ_segment:d",
)
def segment_zscores(spark, sf):
    """Hierarchical first-match segment z-scores."""
    return _flights(spark, sf).select(
        "OrderKey", "Residual_kg", "ResidualMean_segment", "ResidualStd_segment", "SegmentBasis",
        "ResidualZ_global", "ResidualZ_segment",
    )


_FLAG_COLS = (
    "OrderKey, IsAnomaly, IsOverburnAnomaly, IsUnderburnAnomaly, AnomalyType, PossibleDataIssue, LikelyIssueClass"
)


@query("anomaly_flags", f"SELECT {_FLAG_COLS} FROM flights", _FLAG_COLS)
def anomaly_flags(spark, sf):
    """Two-sided flags, type, data-issue rule, issue cascade."""
    return _flights(spark, sf).select(*[c.strip() for c in _FLAG_COLS.split(",")])


_ANOM_COLS = (
    "ScheduledRoute, AircraftTypeGroup, Carrier, Origin, Destination, Season, DepartureHourBand, LoadFactor, "
    "RouteDistanceKm:d, ActualBurn_kg, PredictedBurn_kg, ExcessBurn_kg, Residual_kg, AnomalyType, "
    "AnomalyScore:d, LikelyIssueClass, OpsPlanningGap_kg"
)


@query(
    "anomalies",
    "SELECT *, abs(ResidualZ_segment) AS AnomalyScore FROM flights WHERE IsAnomaly",
    _ANOM_COLS,
)
def anomalies(spark, sf):
    """C17: flagged flights with |z| as the score."""
    return value.anomaly_list(_flights(spark, sf))


@query(
    "flight_analytics",
    "SELECT * FROM flights",
    ", ".join(
        c + (":d" if c in {
            "ActualBurnPerKm", "PredictedBurnPerKm", "IntensityGapPerKm", "BurnPerPaxKm_actual", "BurnPerPaxKm_pred",
            "ResidualZ_global", "ResidualZ_segment",
        } else "")
        for c in value.FLIGHT_COLUMNS
    ),
)
def flight_analytics(spark, sf):
    """The 44-column flight analytics export with annualised values."""
    return _flights(spark, sf).select(*value.FLIGHT_COLUMNS)


@query(
    "annualised_totals",
    f"SELECT {fsum('AvoidableFuelCost_eur')} * CAST(550000.0 AS DOUBLE) / count(*) AS AnnualAvoidableCost_eur, "
    f"{fsum('AvoidableCO2_kg')} * CAST(550000.0 AS DOUBLE) / count(*) / 1000 AS AnnualAvoidableCO2_t, "
    f"{fsum('CarryPenaltyCost_eur')} * CAST(550000.0 AS DOUBLE) / count(*) AS AnnualCarryPenalty_eur FROM flights",
    "AnnualAvoidableCost_eur, AnnualAvoidableCO2_t, AnnualCarryPenalty_eur",
)
def annualised_totals(spark, sf):
    """Annualised avoidable cost, CO2 and carry penalty."""
    return value.annual_totals(_flights(spark, sf))


@query(
    "anomaly_kpis",
    "SELECT count(*) FILTER (WHERE IsAnomaly) AS AnomalyCount, avg(CAST(IsAnomaly AS DOUBLE)) AS AnomalyShare, "
    "count(*) FILTER (WHERE IsOverburnAnomaly) AS OverburnCount, count(*) FILTER (WHERE IsUnderburnAnomaly) AS UnderburnCount, "
    "count(*) FILTER (WHERE PossibleDataIssue) AS DataIssueCount, count(*) AS Flights FROM flights",
    "AnomalyCount, AnomalyShare, OverburnCount, UnderburnCount, DataIssueCount, Flights",
)
def anomaly_kpis(spark, sf):
    """Anomaly headline counts and share."""
    return value.anomaly_kpis(_flights(spark, sf))


# ---------------------------------------------------------------------------
# Stage 6: rollups


def _opp_score_sql(frame: str, by: str | None) -> str:
    """SQL twin of ``segments.opportunity_score`` over a CTE named ``frame``."""
    if by:
        med = f"(SELECT {by} AS _k, quantile_cont(ResidualStd, 0.5) AS _med FROM {frame} GROUP BY 1) m ON m._k = t.{by}"
        join = f"LEFT JOIN {med}"
    else:
        join = f"CROSS JOIN (SELECT quantile_cont(ResidualStd, 0.5) AS _med FROM {frame}) m"
    den = "(m._med + CAST(1e-9 AS DOUBLE))"
    ratio = f"(CASE WHEN {den} = 0 THEN CAST(1.0 AS DOUBLE) ELSE t.ResidualStd / {den} END)"
    stab = f"least(greatest(coalesce(1.0 - {ratio}, 0.0), 0.0), 1.0)"
    vol = "ln(1 + greatest(CAST(t.FlightCount AS DOUBLE), 0.0))"
    return (
        f"SELECT t.*, coalesce(t.AnnualAvoidableCost_eur, 0.0) * coalesce(t.PositiveExcessRate, 0.0) "
        f"* greatest(coalesce({vol}, 1.0), 1.0) * (0.5 + 0.5 * {stab}) AS OpportunityScore FROM {frame} t {join}"
    )


_ROUTE_OPP_SQL = f"""
WITH ra AS (
  SELECT ScheduledRoute, count(*) AS FlightCount, avg(ActualBurn_kg) AS MeanActualBurn, avg(PredictedBurn_kg) AS MeanPredictedBurn,
         avg(ExcessBurn_kg) AS MeanExcessBurn, quantile_cont(ExcessBurn_kg, 0.5) AS MedianExcessBurn,
         quantile_cont(ExcessBurn_kg, 0.9) AS P90ExcessBurn,
         avg(CASE WHEN coalesce(ExcessBurn_kg > 0, false) THEN 1.0 ELSE 0.0 END) AS PositiveExcessRate,
         coalesce({fsum("AvoidableCO2_kg")}, 0.0) AS TotalAvoidableCO2_kg, coalesce({fsum("AvoidableFuelCost_eur")}, 0.0) AS TotalAvoidableCost_eur,
         avg(AvoidableFuelCost_eur) AS MeanAvoidableCost_eur, avg(StructuralCO2_kg) AS MeanStructuralCO2_kg,
         avg(AvoidableCO2_kg) AS MeanAvoidableCO2_kg,
         avg(CASE WHEN coalesce(IsAnomaly, false) THEN 1.0 ELSE 0.0 END) AS AnomalyRate,
         avg(CASE WHEN coalesce(IsOverburnAnomaly, false) THEN 1.0 ELSE 0.0 END) AS OverburnAnomalyRate,
         stddev_pop(Residual_kg) AS ResidualStd, sqrt(avg(ExcessBurn_kg * ExcessBurn_kg)) AS RouteRMSE,
         avg(OpsPlanningGap_kg) AS MeanOpsPlanningGap_kg, avg(LoadFactor) AS MeanLoadFactor, avg(RouteDistanceKm) AS MeanDistanceKm
  FROM flights WHERE ScheduledRoute IS NOT NULL GROUP BY 1
),
rmode AS (
  SELECT ScheduledRoute, AircraftTypeGroup AS AircraftTypeMode FROM (
    SELECT ScheduledRoute, AircraftTypeGroup, row_number() OVER (PARTITION BY ScheduledRoute ORDER BY count(*) DESC, AircraftTypeGroup) AS rk
    FROM flights WHERE ScheduledRoute IS NOT NULL AND AircraftTypeGroup IS NOT NULL GROUP BY 1, 2) WHERE rk = 1
),
rb AS (
  SELECT ra.*, coalesce(rmode.AircraftTypeMode, 'Unknown') AS AircraftTypeMode,
         TotalAvoidableCO2_kg * scale._scale / 1000 AS AnnualAvoidableCO2_t,
         TotalAvoidableCost_eur * scale._scale AS AnnualAvoidableCost_eur,
         CASE WHEN MeanStructuralCO2_kg = 0 THEN NULL ELSE MeanAvoidableCO2_kg / MeanStructuralCO2_kg END AS StructuralVsAvoidableRatio,
         least(greatest(FlightCount / CAST(25.0 AS DOUBLE), 0.0), 1.0) AS ConfidenceScore
  FROM ra LEFT JOIN rmode ON ra.ScheduledRoute = rmode.ScheduledRoute CROSS JOIN scale
),
rs AS ({_opp_score_sql('rb', None)}),
geo AS (
  SELECT r.ScheduledRoute, string_split(r.ScheduledRoute, '-')[1] AS Origin, string_split(r.ScheduledRoute, '-')[2] AS Destination,
         o.lat AS OrgLat, o.lon AS OrgLon, d.lat AS DstLat, d.lon AS DstLon,
         coalesce(o.city, string_split(r.ScheduledRoute, '-')[1]) AS OrgCity, coalesce(d.city, string_split(r.ScheduledRoute, '-')[2]) AS DstCity
  FROM (SELECT DISTINCT ScheduledRoute FROM flights WHERE ScheduledRoute IS NOT NULL) r
  LEFT JOIN airports o ON upper(string_split(r.ScheduledRoute, '-')[1]) = o.iata
  LEFT JOIN airports d ON upper(string_split(r.ScheduledRoute, '-')[2]) = d.iata
  WHERE o.lat IS NOT NULL AND o.lon IS NOT NULL
)
SELECT rs.*, FlightCount * (CASE WHEN MeanExcessBurn IS NULL THEN NULL ELSE greatest(MeanExcessBurn, 0.0) END) AS VolumePriority,
       FlightCount >= {C.MIN_SEGMENT_SIZE} AND coalesce(PositiveExcessRate >= {C.PERSISTENT_RATE}, false) AND coalesce(MeanExcessBurn > 0, false)
         AS PersistentOverburnFlag,
       geo.Origin, geo.Destination, geo.OrgLat, geo.OrgLon, geo.DstLat, geo.DstLon, geo.OrgCity, geo.DstCity
FROM rs LEFT JOIN geo ON rs.ScheduledRoute = geo.ScheduledRoute
"""
_ROUTE_OPP_COLS = (
    "ScheduledRoute, FlightCount, MeanActualBurn:d, MeanPredictedBurn:d, MeanExcessBurn:d, MedianExcessBurn:d, "
    "P90ExcessBurn:d, PositiveExcessRate, TotalAvoidableCO2_kg, TotalAvoidableCost_eur, MeanAvoidableCost_eur:d, "
    "MeanStructuralCO2_kg:d, MeanAvoidableCO2_kg:d, AnomalyRate, OverburnAnomalyRate, ResidualStd:d, RouteRMSE:d, "
    "MeanOpsPlanningGap_kg:d, MeanLoadFactor:d, MeanDistanceKm:d, AircraftTypeMode, AnnualAvoidableCO2_t, "
    "AnnualAvoidableCost_eur, StructuralVsAvoidableRatio:d, ConfidenceScore, OpportunityScore:d, VolumePriority:d, "
    "PersistentOverburnFlag, Origin, Destination, OrgLat, OrgLon, DstLat, DstLon, OrgCity, DstCity"
)


def _route_opp(spark, sf):
    return segments.route_opportunity(_flights(spark, sf), _airports(spark, sf))


@query("route_opportunity", _ROUTE_OPP_SQL, _ROUTE_OPP_COLS)
def route_opportunity(spark, sf):
    """Route rollup, annualised, scored, flagged, with geography."""
    return _route_opp(spark, sf)


@query(
    "co2_hotspots",
    f"SELECT ScheduledRoute, FlightCount, MeanDistanceKm, MeanLoadFactor, MeanStructuralCO2_kg, MeanAvoidableCO2_kg, "
    f"AnnualAvoidableCO2_t, StructuralVsAvoidableRatio, OpportunityScore FROM ({_ROUTE_OPP_SQL})",
    "ScheduledRoute, FlightCount, MeanDistanceKm:d, MeanLoadFactor:d, MeanStructuralCO2_kg:d, MeanAvoidableCO2_kg:d, "
    "AnnualAvoidableCO2_t, StructuralVsAvoidableRatio:d, OpportunityScore:d",
)
def co2_hotspots(spark, sf):
    """The sustainability projection of the route table."""
    return segments.co2_hotspots(_route_opp(spark, sf))


def _seg_union_sql(specs, measures_sql: str) -> str:
    parts = []
    used = [k for k in segments.ALL_KEYS if any(k in cols for _, cols in specs)]
    for label, cols in specs:
        from .oracle_base import _seg_name

        name = _seg_name(cols)
        nn = " AND ".join(f"{c} IS NOT NULL" for c in cols)
        keysel = ", ".join(
            (f"CAST({k} AS VARCHAR) AS {k}" if k in cols else f"CAST(NULL AS VARCHAR) AS {k}") for k in used
        )
        gb = ", ".join(cols)
        parts.append(
            f"SELECT '{label}' AS SegmentType, {name} AS SegmentName, {keysel}, {measures_sql} FROM flights WHERE {nn} GROUP BY {gb}"
        )
    return "\nUNION ALL\n".join(parts)


_SEG_MEASURES = (
    "count(*) AS FlightCount, avg(ExcessBurn_kg) AS MeanExcessBurn, "
    "avg(CASE WHEN coalesce(ExcessBurn_kg > 0, false) THEN 1.0 ELSE 0.0 END) AS PositiveExcessRate, "
    "avg(CASE WHEN coalesce(IsAnomaly, false) THEN 1.0 ELSE 0.0 END) AS AnomalyRate, "
    "avg(CASE WHEN coalesce(IsOverburnAnomaly, false) THEN 1.0 ELSE 0.0 END) AS OverburnAnomalyRate, "
    f"avg(AvoidableFuelCost_eur) AS MeanAvoidableCost_eur, coalesce({fsum('AvoidableFuelCost_eur')}, 0.0) AS TotalAvoidableCost_eur, "
    f"coalesce({fsum('AvoidableCO2_kg')}, 0.0) AS TotalAvoidableCO2_kg, stddev_pop(Residual_kg) AS ResidualStd, "
    "avg(StructuralCO2_kg) AS MeanStructuralCO2_kg, avg(OpsPlanningGap_kg) AS MeanOpsPlanningGap_kg, "
    "quantile_cont(ExcessBurn_kg, 0.5) AS MedianExcessBurn"
)

_SEG_OPP_SQL = f"""
WITH sa AS (
{_seg_union_sql(C.SEGMENT_SPECS, _SEG_MEASURES)}
),
sb AS (
  SELECT sa.*, TotalAvoidableCost_eur * scale._scale AS AnnualAvoidableCost_eur,
         TotalAvoidableCO2_kg * scale._scale / 1000 AS AnnualAvoidableCO2_t,
         least(greatest(FlightCount / CAST(25.0 AS DOUBLE), 0.0), 1.0) AS ConfidenceScore
  FROM sa CROSS JOIN scale
),
ss AS ({_opp_score_sql('sb', 'SegmentType')})
SELECT ss.*, FlightCount >= {C.MIN_SEGMENT_SIZE} AND coalesce(PositiveExcessRate >= {C.PERSISTENT_RATE}, false)
       AND coalesce(MeanExcessBurn > 0, false) AS PersistentOverburnFlag
FROM ss
"""
_SEG_OPP_COLS = (
    "SegmentType, SegmentName, ScheduledRoute, AircraftTypeGroup, Carrier, Origin, Destination, Season, DepartureHourBand, "
    "LoadFactorBand, DistanceBand, FlightCount, MeanExcessBurn:d, PositiveExcessRate, AnomalyRate, OverburnAnomalyRate, "
    "MeanAvoidableCost_eur:d, TotalAvoidableCost_eur, TotalAvoidableCO2_kg, ResidualStd:d, MeanStructuralCO2_kg:d, "
    "MeanOpsPlanningGap_kg:d, MedianExcessBurn:d, AnnualAvoidableCost_eur, AnnualAvoidableCO2_t, ConfidenceScore, "
    "OpportunityScore:d, PersistentOverburnFlag"
)


def _seg_opp(spark, sf):
    return segments.segment_opportunity(_flights(spark, sf))


@query("segment_opportunity", _SEG_OPP_SQL, _SEG_OPP_COLS)
def segment_opportunity(spark, sf):
    """11 segment definitions in one shared scan, scored per type."""
    return _seg_opp(spark, sf)


_MON_MEASURES = (
    "count(*) AS FlightCount, count(*) FILTER (WHERE IsAnomaly) AS AnomalyCount, "
    "count(*) FILTER (WHERE IsOverburnAnomaly) AS OverburnCount, count(*) FILTER (WHERE IsUnderburnAnomaly) AS UnderburnCount, "
    "avg(CASE WHEN coalesce(IsAnomaly, false) THEN 1.0 ELSE 0.0 END) AS AnomalyRate, avg(ExcessBurn_kg) AS MeanExcessBurn, "
    "stddev_pop(Residual_kg) AS ResidualStd, avg(OpsPlanningGap_kg) AS MeanOpsPlanningGap_kg"
)
_MON_SQL = f"""
SELECT m.*, FlightCount >= {C.MIN_SEGMENT_SIZE} AND coalesce(AnomalyRate >= {C.MONITOR_PERSISTENT_RATE}, false) AS PersistenceFlag,
       CASE WHEN coalesce(MeanOpsPlanningGap_kg > {C.PLANNING_GAP_KG}, false) THEN 'Planning bias / conservative fuel loading'
            WHEN coalesce(MeanExcessBurn > 0, false) THEN 'Recurring operational over-burn'
            ELSE 'Mixed / low-signal' END AS LikelyIssueClass
FROM (
{_seg_union_sql(C.MONITOR_SPECS, _MON_MEASURES)}
) m
"""
_MON_COLS = (
    "SegmentType, SegmentName, ScheduledRoute, AircraftTypeGroup, Origin, DepartureHourBand, Season, FlightCount, "
    "AnomalyCount, OverburnCount, UnderburnCount, AnomalyRate, MeanExcessBurn:d, ResidualStd:d, MeanOpsPlanningGap_kg:d, "
    "PersistenceFlag, LikelyIssueClass"
)


def _monitor(spark, sf):
    return segments.anomaly_monitor(_flights(spark, sf))


@query("anomaly_monitor", _MON_SQL, _MON_COLS)
def anomaly_monitor(spark, sf):
    """Persistent anomaly monitor over 5 segment definitions."""
    return _monitor(spark, sf)


@query(
    "persistence_by_type",
    f"""
    SELECT SegmentType, avg(CAST(PersistenceFlag AS DOUBLE)) * 100 AS PersistentPct, avg(AnomalyRate) * 100 AS MeanAnomalyRatePct,
           count(*) AS Segments
    FROM ({_MON_SQL}) WHERE FlightCount >= 5 GROUP BY 1
    """,
    "SegmentType, PersistentPct, MeanAnomalyRatePct:d, Segments",
)
def persistence_by_type(spark, sf):
    """Share of persistent segments and mean anomaly rate per segment type."""
    return segments.persistence_by_type(_monitor(spark, sf), 5)


_SCEN_TYPES = ", ".join(f"'{t}'" for t in C.SCENARIO_SEGMENT_TYPES)


_SCEN_SQL = f"""
    WITH base AS (SELECT *, AnnualAvoidableCost_eur AS CurrentAnnualValue_eur FROM ({_SEG_OPP_SQL}) WHERE SegmentType IN ({_SCEN_TYPES}))
    SELECT base.*, '{C.SCENARIOS[0][0]}' AS Scenario, CurrentAnnualValue_eur * {C.SCENARIOS[0][1]} AS SavingsPotential_eur,
           AnnualAvoidableCO2_t * {C.SCENARIOS[0][1]} AS SavingsPotential_CO2_t FROM base
    UNION ALL
    SELECT base.*, '{C.SCENARIOS[1][0]}', CurrentAnnualValue_eur * {C.SCENARIOS[1][1]}, AnnualAvoidableCO2_t * {C.SCENARIOS[1][1]} FROM base
    UNION ALL
    SELECT base.*, '{C.PEER_SCENARIO}',
           CurrentAnnualValue_eur * (CASE WHEN PositiveExcessRate IS NULL THEN NULL ELSE least(greatest(PositiveExcessRate - 0.5, 0.0), 1.0) END),
           AnnualAvoidableCO2_t * (CASE WHEN PositiveExcessRate IS NULL THEN NULL ELSE least(greatest(PositiveExcessRate - 0.5, 0.0), 1.0) END)
    FROM base
    """


@query(
    "scenarios",
    _SCEN_SQL,
    _SEG_OPP_COLS + ", CurrentAnnualValue_eur, Scenario, SavingsPotential_eur:d, SavingsPotential_CO2_t:d",
)
def scenarios(spark, sf):
    """Three intervention scenarios per qualifying segment."""
    return segments.intervention_scenarios(_seg_opp(spark, sf))


def _vs_sql() -> str:
    base_rmse = "sqrt(avg((BaselinePred_kg - ActualBurn_kg) * (BaselinePred_kg - ActualBurn_kg)))"
    model_rmse = "sqrt(avg((PredictedBurn_kg - ActualBurn_kg) * (PredictedBurn_kg - ActualBurn_kg)))"
    scale = "(CAST(550000.0 AS DOUBLE) / count(*))"
    return f"""
    WITH a AS (
      SELECT {base_rmse} AS base_rmse, {model_rmse} AS model_rmse,
             sum(AvoidableFuelCost_eur) * {scale} AS cost, sum(AvoidableCO2_kg) * {scale} / 1000 AS co2,
             sum(CarryPenaltyCost_eur) * {scale} AS carry FROM flights
    ), b AS (
      SELECT *, CAST({C.BUFFER_Z} AS DOUBLE) * greatest(base_rmse - model_rmse, 0.0) AS buffer FROM a
    ), c AS (
      SELECT *, buffer * CAST({C.FUEL_CARRY_PENALTY} AS DOUBLE) * {C.ANNUAL_FLIGHTS} / 1000 AS fuel_t,
             co2 * CAST({C.ETS_PRICE_PER_TONNE} AS DOUBLE) AS ets FROM b
    )
    SELECT 0 AS Ord, 'Primary model' AS Metric, CAST(NULL AS DOUBLE) AS Value, 'GroupMean' AS ValueText FROM c
    UNION ALL SELECT 1, 'Baseline RMSE (kg)', round_even(base_rmse, 1), NULL FROM c
    UNION ALL SELECT 2, 'Model RMSE (kg)', round_even(model_rmse, 1), NULL FROM c
    UNION ALL SELECT 3, 'Buffer reduction per flight (kg)', round_even(buffer, 1), NULL FROM c
    UNION ALL SELECT 4, 'Annual buffer fuel saved (tonnes)', round_even(fuel_t, 0), NULL FROM c
    UNION ALL SELECT 5, 'Annual buffer cost savings (EUR)', round_even(fuel_t * 1000 * CAST({C.FUEL_PRICE_PER_KG} AS DOUBLE), 0), NULL FROM c
    UNION ALL SELECT 6, 'Annual buffer CO2 avoided (tonnes)', round_even(fuel_t * CAST({C.CO2_PER_KG_FUEL} AS DOUBLE), 0), NULL FROM c
    UNION ALL SELECT 7, 'Annual avoidable operational cost (EUR)', round_even(cost, 0), NULL FROM c
    UNION ALL SELECT 8, 'Annual avoidable operational CO2 (tonnes)', round_even(co2, 0), NULL FROM c
    UNION ALL SELECT 9, 'Annual planning carry penalty (EUR)', round_even(carry, 0), NULL FROM c
    UNION ALL SELECT 10, 'Annual ETS savings on avoidable CO2 (EUR)', round_even(ets, 0), NULL FROM c
    UNION ALL SELECT 11, 'Total annual value (EUR)', round_even(cost + carry + ets, 0), NULL FROM c
    """


@query("value_summary", _vs_sql(), "Ord, Metric, Value:d, ValueText")
def value_summary(spark, sf):
    """The key/value metric table (buffer savings, annual values, ETS)."""
    return value.value_summary(_flights(spark, sf))


# ---------------------------------------------------------------------------
# Dashboard tables


@query(
    "kpis",
    "SELECT count(*) AS Flights, count(DISTINCT ScheduledRoute) AS Routes, avg(Burnoff) AS MeanBurnoff, "
    "count(DISTINCT Carrier) AS Carriers FROM eng",
    "Flights, Routes, MeanBurnoff:d, Carriers",
)
def kpis(spark, sf):
    """Headline KPIs."""
    return views.kpis(_eng(spark, sf))


@query(
    "avoidable_share",
    f"SELECT coalesce({fsum('AvoidableCO2_kg')}, 0.0) AS TotalAvoidableCO2_kg, coalesce({fsum('ActualCO2_kg')}, 0.0) AS TotalActualCO2_kg, "
    f"coalesce({fsum('AvoidableCO2_kg')}, 0.0) / greatest(coalesce({fsum('ActualCO2_kg')}, 0.0), 1.0) AS AvoidableShare FROM flights",
    "TotalAvoidableCO2_kg, TotalActualCO2_kg, AvoidableShare",
)
def avoidable_share(spark, sf):
    """Avoidable share of actual CO2."""
    return views.avoidable_share(_flights(spark, sf))


@query(
    "co2_by_type",
    "SELECT AircraftTypeGroup, avg(StructuralCO2_kg) AS MeanStructuralCO2_kg, avg(AvoidableCO2_kg) AS MeanAvoidableCO2_kg, "
    "count(*) AS Flights, CASE WHEN avg(StructuralCO2_kg) + avg(AvoidableCO2_kg) = 0 THEN NULL "
    "ELSE avg(AvoidableCO2_kg) * 100 / (avg(StructuralCO2_kg) + avg(AvoidableCO2_kg)) END AS AvoidableSharePct "
    "FROM flights WHERE AircraftTypeGroup IS NOT NULL GROUP BY 1",
    "AircraftTypeGroup, MeanStructuralCO2_kg:d, MeanAvoidableCO2_kg:d, Flights, AvoidableSharePct:d",
)
def co2_by_type(spark, sf):
    """Structural vs avoidable CO2 per type."""
    return views.co2_by_type(_flights(spark, sf))


@query(
    "co2_by_load_band",
    "SELECT LoadFactorBand, avg(StructuralCO2_kg) AS MeanStructuralCO2_kg, avg(AvoidableCO2_kg) AS MeanAvoidableCO2_kg, "
    "avg(ActualCO2_kg) AS MeanActualCO2_kg, count(*) AS Flights FROM flights GROUP BY 1",
    "LoadFactorBand, MeanStructuralCO2_kg:d, MeanAvoidableCO2_kg:d, MeanActualCO2_kg:d, Flights",
)
def co2_by_load_band(spark, sf):
    """CO2 by load-factor band."""
    return views.co2_by_load_band(_flights(spark, sf))


@query(
    "threshold_shares",
    f"SELECT avg(CASE WHEN coalesce(ActualBurn_kg >= 10000, false) THEN 1.0 ELSE 0.0 END) * 100 AS HeavyBurnPct, "
    f"avg(CASE WHEN coalesce(RouteDistanceKm >= 3000, false) THEN 1.0 ELSE 0.0 END) * 100 AS LongHaulPct, "
    f"avg(CASE WHEN coalesce(abs(ResidualZ_segment) >= {C.ANOMALY_Z}, false) THEN 1.0 ELSE 0.0 END) * 100 AS BeyondZPct FROM flights",
    "HeavyBurnPct, LongHaulPct, BeyondZPct",
)
def threshold_shares(spark, sf):
    """Shares above fixed thresholds."""
    return views.threshold_shares(_flights(spark, sf))


_RE_OK = "FlightCount >= 5 AND OrgLat IS NOT NULL AND OrgLon IS NOT NULL AND DstLat IS NOT NULL AND DstLon IS NOT NULL"


@query(
    "airport_layer",
    f"SELECT Origin, OrgLat, OrgLon, OrgCity, avg(MeanBurnoff) AS MetricMean, sum(FlightCount) AS Flights, "
    f"pow(sum(FlightCount), 0.45) * 2 AS MarkerSize FROM ({_ROUTE_ERR_SQL}) WHERE {_RE_OK} GROUP BY 1, 2, 3, 4",
    "Origin, OrgLat, OrgLon, OrgCity, MetricMean:d, Flights, MarkerSize:d",
)
def airport_layer(spark, sf):
    """Origin-airport aggregate with marker size."""
    return views.airport_layer(_route_err(spark, sf), "MeanBurnoff", 5)


@query(
    "route_arcs",
    f"SELECT ScheduledRoute, FlightCount, OrgLat, OrgLon, DstLat, DstLon, (OrgLat + DstLat) / 2 + 2 AS MidLat, "
    f"(OrgLon + DstLon) / 2 AS MidLon FROM ({_ROUTE_ERR_SQL}) WHERE {_RE_OK} ORDER BY FlightCount DESC, ScheduledRoute LIMIT 500",
    "ScheduledRoute, FlightCount, OrgLat, OrgLon, DstLat, DstLon, MidLat, MidLon",
)
def route_arcs(spark, sf):
    """Top-500 arcs with a lifted midpoint."""
    return views.route_arcs(_route_err(spark, sf), 5, 500)


_TOP_TYPES_SQL = (
    "SELECT AircraftTypeGroup FROM eng WHERE AircraftTypeGroup IS NOT NULL GROUP BY 1 "
    "ORDER BY count(*) DESC, AircraftTypeGroup LIMIT 3"
)


@query(
    "semi_filtered_routes",
    f"SELECT * FROM ({_ROUTE_ERR_SQL}) re WHERE re.ScheduledRoute IN "
    f"(SELECT ScheduledRoute FROM eng WHERE AircraftTypeGroup IN ({_TOP_TYPES_SQL}))",
    _ROUTE_ERR_COLS,
)
def semi_filtered_routes(spark, sf):
    """Routes flown by the three busiest aircraft types (semi joins)."""
    e = _eng(spark, sf)
    return views.routes_flown_by(_route_err(spark, sf), e, views.top_types_by_volume(e, 3))


@query(
    "airport_drilldown",
    f"""
    WITH re AS ({_ROUTE_ERR_SQL}),
    ends AS (
      SELECT DISTINCT City, ScheduledRoute, FlightCount, MeanBurnoff, MAPE FROM (
        SELECT OrgCity AS City, ScheduledRoute, FlightCount, MeanBurnoff, MAPE FROM re
        UNION ALL SELECT DstCity, ScheduledRoute, FlightCount, MeanBurnoff, MAPE FROM re) WHERE City IS NOT NULL
    )
    SELECT * FROM (SELECT ends.*, CAST(row_number() OVER (PARTITION BY City ORDER BY FlightCount DESC, ScheduledRoute) AS INTEGER) AS Rank
                   FROM ends) WHERE Rank <= 12
    """,
    "City, ScheduledRoute, FlightCount, MeanBurnoff:d, MAPE:d, Rank",
)
def airport_drilldown(spark, sf):
    """The 12 busiest routes through every city."""
    return views.airport_drilldown(_route_err(spark, sf), 12)


@query(
    "busiest_routes",
    f"SELECT ScheduledRoute, FlightCount, MeanBurnoff FROM ({_ROUTE_ERR_SQL}) ORDER BY FlightCount DESC, ScheduledRoute LIMIT 15",
    "ScheduledRoute, FlightCount, MeanBurnoff:d",
)
def busiest_routes(spark, sf):
    """C22 default: the 15 busiest routes."""
    return views.busiest_routes(_route_err(spark, sf), 15)


@query(
    "hour_heatmap",
    f"""
    WITH so AS ({_SEG_OPP_SQL}),
    ah AS (SELECT string_split(SegmentName, ' | ')[1] AS Origin, string_split(SegmentName, ' | ')[2] AS HourBand,
                  AnomalyRate * 100 AS RatePct FROM so WHERE SegmentType = 'Airport × Hour'),
    cells AS (SELECT Origin, HourBand, avg(RatePct) AS RatePct FROM ah GROUP BY 1, 2),
    nb AS (SELECT count(DISTINCT HourBand) AS _bands FROM cells),
    per AS (SELECT Origin, sum(coalesce(RatePct, 0.0)) AS _sum, max(coalesce(RatePct, 0.0)) AS MaxRatePct FROM cells GROUP BY 1),
    hot AS (SELECT Origin, HourBand AS HottestBand FROM (
              SELECT Origin, HourBand, row_number() OVER (PARTITION BY Origin ORDER BY coalesce(RatePct, 0.0) DESC, HourBand) AS r
              FROM cells) WHERE r = 1)
    SELECT per.Origin, per._sum / nb._bands AS RowMeanPct, hot.HottestBand, per.MaxRatePct
    FROM per CROSS JOIN nb JOIN hot ON per.Origin = hot.Origin
    ORDER BY RowMeanPct DESC, per.Origin LIMIT 15
    """,
    "Origin, RowMeanPct:d, HottestBand, MaxRatePct:d",
)
def hour_heatmap(spark, sf):
    """Airport x hour anomaly-rate matrix, top-15 origins by row mean."""
    return views.hour_hotspots(_seg_opp(spark, sf), 15)


@query(
    "what_if",
    f"""
    WITH e AS (SELECT * FROM eng WHERE AircraftTypeGroup IS NOT NULL AND ScheduledRoute IS NOT NULL),
    rt AS (SELECT AircraftTypeGroup, ScheduledRoute, count(*) AS _n, avg(Burnoff) AS _rb, avg(LoadFactor) AS _rl,
                  covar_samp(LoadFactor, Burnoff) AS _cov, var_samp(LoadFactor) AS _var, stddev_samp(Burnoff) AS _rs,
                  avg(RouteDistanceKm) AS _rd FROM e GROUP BY 1, 2),
    ty AS (SELECT AircraftTypeGroup, avg(Burnoff) AS _tb, avg(LoadFactor) AS _tl, stddev_samp(Burnoff) AS _ts,
                  avg(RouteDistanceKm) AS _td, avg(AircraftCapacity) AS _cap FROM e GROUP BY 1),
    g AS (SELECT rt.*, ty._tb, ty._tl, ty._ts, ty._td, ty._cap, l.LoadFactorScenario
          FROM rt JOIN ty ON rt.AircraftTypeGroup = ty.AircraftTypeGroup
          CROSS JOIN (SELECT unnest([CAST(0.6 AS DOUBLE), CAST(0.8 AS DOUBLE), CAST(0.95 AS DOUBLE)]) AS LoadFactorScenario) l),
    h AS (SELECT g.*, greatest(CASE WHEN _n >= {C.WHAT_IF_MIN_ROWS}
                                 THEN _rb + (LoadFactorScenario - _rl) * (CASE WHEN _var > 0 THEN _cov / _var ELSE 500.0 END)
                                 ELSE _tb + (LoadFactorScenario - _tl) * CAST({C.WHAT_IF_KG_PER_LOAD} AS DOUBLE) END,
                            CAST({C.WHAT_IF_FLOOR_KG} AS DOUBLE)) AS est,
                 CAST(trunc(LoadFactorScenario * _cap) AS BIGINT) AS pax FROM g)
    SELECT AircraftTypeGroup, ScheduledRoute, LoadFactorScenario, est AS PredictedBurnoff_kg,
           est * CAST({C.CO2_PER_KG_FUEL} AS DOUBLE) AS CO2_kg, pax AS EstPassengers,
           est * CAST({C.CO2_PER_KG_FUEL} AS DOUBLE) / greatest(pax, 1) AS CO2PerPax_kg,
           CASE WHEN _n >= {C.WHAT_IF_MIN_ROWS} THEN _rs ELSE _ts END AS StdBurnoff_kg,
           CASE WHEN _n >= {C.WHAT_IF_MIN_ROWS} THEN _rd ELSE _td END AS DistanceKm,
           CASE WHEN _n >= {C.WHAT_IF_MIN_ROWS} THEN _n ELSE 0 END AS HistoricalFlights
    FROM h
    """,
    "AircraftTypeGroup, ScheduledRoute, LoadFactorScenario, PredictedBurnoff_kg:d, CO2_kg:d, EstPassengers, "
    "CO2PerPax_kg:d, StdBurnoff_kg:d, DistanceKm:d, HistoricalFlights",
)
def what_if(spark, sf):
    """What-if burn / CO2 table for every observed (type, route) at three load factors."""
    return views.what_if(_eng(spark, sf))


@query(
    "fleet_comparison",
    f"SELECT ScheduledRoute, AircraftTypeGroup, count(*) AS Flights, round_even(avg(Burnoff), 0) AS AvgBurnoff_kg, "
    f"round_even(avg(Burnoff) * CAST({C.CO2_PER_KG_FUEL} AS DOUBLE), 0) AS CO2_kg FROM eng "
    f"WHERE AircraftTypeGroup IS NOT NULL AND ScheduledRoute IS NOT NULL GROUP BY 1, 2 HAVING count(*) >= 3",
    "ScheduledRoute, AircraftTypeGroup, Flights, AvgBurnoff_kg:d, CO2_kg:d",
)
def fleet_comparison(spark, sf):
    """C20: per route, types with >= 3 flights: mean burn and CO2."""
    return views.fleet_comparison(_eng(spark, sf), 3)


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from . import catalog_jobs, catalog_models, catalog_more, catalog_tables  # noqa: F401  (register the remaining queries)

    return dict(QUERIES)


def all_oracles() -> dict[str, str]:
    from . import catalog_jobs, catalog_models, catalog_more, catalog_tables  # noqa: F401

    return dict(ORACLES)
