"""Ranked business, emission, anomaly and story tables (C24-C28, T2/T3, A33,
A39, A41, M32, M34, P9).

Top-n tables use TakeOrderedAndProject; the rank window then sees n rows.
Sort keys are rounded to 6 decimals with the row's name as the tie-break, so
the order doesn't hang on the last bits of a sum.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from ..functions import scalar as S
from ..functions.quantile import exact_quantiles
from .residuals import equal_width_bins, trim_above_quantile
from .sizing import with_scalars


def by_desc(name: str) -> Column:
    return F.desc(F.round(F.col(name), 6))


def ranked(df: DataFrame, n: int, *order: Column | str) -> DataFrame:
    """The first ``n`` rows in order, with their ``Rank``."""
    top = df.orderBy(*order).limit(n)
    return top.withColumn("Rank", F.row_number().over(Window.orderBy(*order)))


def opportunity_matrix(routes: DataFrame, n: int = 100, min_flights: int = 5) -> DataFrame:
    """Volume against excess burn and annual value, best scores first."""
    top = ranked(routes.where(F.col("FlightCount") >= min_flights), n, by_desc("OpportunityScore"), "ScheduledRoute")
    return top.select("Rank", "ScheduledRoute", "FlightCount", "MeanExcessBurn", "AnnualAvoidableCost_eur", "OpportunityScore")


def top_segments(segments: DataFrame, n: int = 20, min_flights: int = 5) -> DataFrame:
    """Segments by annual avoidable cost."""
    top = ranked(segments.where(F.col("FlightCount") >= min_flights), n, by_desc("AnnualAvoidableCost_eur"), "SegmentType", "SegmentName")
    return top.select("Rank", "SegmentType", "SegmentName", "FlightCount", "AnnualAvoidableCost_eur")


def top_scenarios(scenarios: DataFrame, n: int = 20) -> DataFrame:
    """Interventions by savings potential."""
    top = ranked(scenarios, n, by_desc("SavingsPotential_eur"), "SegmentType", "SegmentName", "Scenario")
    return top.select("Rank", "SegmentType", "SegmentName", "Scenario", "SavingsPotential_eur", "SavingsPotential_CO2_t")


def emission_routes(routes: DataFrame, n: int = 15) -> DataFrame:
    """Routes by annual avoidable CO2."""
    top = ranked(routes, n, by_desc("AnnualAvoidableCO2_t"), "ScheduledRoute")
    return top.select("Rank", "ScheduledRoute", "FlightCount", "AnnualAvoidableCO2_t", "OpportunityScore")


def emission_hotspots(routes: DataFrame, n: int = 80, min_flights: int = 5) -> DataFrame:
    """Structural against avoidable CO2 of the best-scored routes."""
    top = ranked(routes.where(F.col("FlightCount") >= min_flights), n, by_desc("OpportunityScore"), "ScheduledRoute")
    return top.select("Rank", "ScheduledRoute", "FlightCount", "MeanStructuralCO2_kg", "MeanAvoidableCO2_kg", "OpportunityScore")


def recurring_segments(monitor: DataFrame, n: int = 20, min_flights: int = 5) -> DataFrame:
    """Route segments by anomaly rate."""
    rows = monitor.where(F.col("SegmentType").isin("Route", "Route × Aircraft") & (F.col("FlightCount") >= min_flights))
    top = ranked(rows, n, by_desc("AnomalyRate"), "SegmentType", "SegmentName")
    return top.select("Rank", "SegmentType", "SegmentName", "FlightCount", "AnomalyRate", "LikelyIssueClass")


def monitor_order(monitor: DataFrame, n: int = 100) -> DataFrame:
    """The monitor's presentation order, persistent and most anomalous first."""
    order = (F.desc("PersistenceFlag"), by_desc("AnomalyRate"), F.desc("FlightCount"), "SegmentType", "SegmentName")
    return ranked(monitor, n, *order).select("Rank", "SegmentType", "SegmentName", "PersistenceFlag", "AnomalyRate", "FlightCount")


def worst_routes_focus(route_err: DataFrame, n: int = 15, min_flights: int = 10) -> DataFrame:
    """Routes by RMSE; the focus is the first with enough flights."""
    top = ranked(route_err, n, by_desc("RMSE"), "ScheduledRoute").withColumn("Eligible", F.col("FlightCount") >= min_flights)
    first = F.min(F.when(F.col("Eligible"), F.col("Rank"))).over(Window.partitionBy())
    return top.withColumn("IsFocus", S.is_true(F.col("Rank") == first)).select("Rank", "ScheduledRoute", "FlightCount", "RMSE", "Eligible", "IsFocus")


def passenger_load(eng: DataFrame, y: str = C.TARGET) -> DataFrame:
    """Load factor against burn over flights with passengers: correlation
    and mean burn of the emptiest and fullest fifth."""
    flights = eng.where(F.col("TotalPassengers") > 0)
    j = with_scalars(flights, exact_quantiles(flights, "LoadFactor", {"_lo": 0.2, "_hi": 0.8}))
    return j.agg(
        F.corr("LoadFactor", y).alias("Corr"),
        F.avg(F.when(F.col("LoadFactor") <= F.col("_lo"), F.col(y))).alias("MeanLowLoad"),
        F.avg(F.when(F.col("LoadFactor") >= F.col("_hi"), F.col(y))).alias("MeanHighLoad"),
        F.count(F.lit(1)).alias("Flights"),
    )


def passenger_bias(resid: DataFrame, min_passengers: int = 10, bins: int = 10) -> DataFrame:
    """Mean residual per load bin over passenger flights, with its direction."""
    b = equal_width_bins(resid.where((F.col("TotalPassengers") > min_passengers) & F.col("LoadFactor").isNotNull()), "LoadFactor", bins)
    g = b.groupBy("Bin").agg(F.first("BinMid").alias("BinMid"), F.avg("Residual").alias("MeanResidual"), F.count(F.lit(1)).alias("Rows"))
    return g.withColumn("Direction", F.when(F.col("MeanResidual") > 0, "Over-predicted").otherwise("Under-predicted"))


def season_spread(eng: DataFrame, y: str = C.TARGET) -> DataFrame:
    """Median and mean per season, which is highest and lowest by
    median, and the spread of the medians."""
    rows = eng.where(F.col("Season").isNotNull())
    g = rows.groupBy("Season").agg(F.avg(y).alias("Mean"), F.count(y).alias("N"))
    g = g.join(exact_quantiles(rows, y, {"Q1": 0.25, "Median": 0.5, "Q3": 0.75}, by=["Season"]), "Season")
    ends = g.agg(F.max_by("Season", "Median").alias("_top"), F.min_by("Season", "Median").alias("_low"), (F.max("Median") - F.min("Median")).alias("MedianSpread"))
    out = with_scalars(g, ends)
    return out.select("Season", "N", "Q1", "Median", "Q3", "Mean", (F.col("Season") == F.col("_top")).alias("IsHighest"), (F.col("Season") == F.col("_low")).alias("IsLowest"), "MedianSpread")


def hour_matrix(segment_opp: DataFrame, n: int = 15) -> DataFrame:
    """The airport x hour anomaly matrix in long form: the ``n`` origins with
    the highest row mean, every hour band (absent cells are 0), and which single
    cell is the hottest."""
    cells = segment_opp.where(F.col("SegmentType") == "Airport × Hour").select(
        S.segment_part("SegmentName", 0).alias("Origin"), S.segment_part("SegmentName", 1).alias("HourBand"), (F.col("AnomalyRate") * 100).alias("RatePct")
    )
    cells = cells.groupBy("Origin", "HourBand").agg(F.avg("RatePct").alias("RatePct"))
    seen = cells.agg(F.array_sort(F.collect_set("HourBand")).alias("_bands"))  # a handful of labels
    rows = cells.groupBy("Origin").agg(F.map_from_entries(F.collect_list(F.struct("HourBand", F.coalesce("RatePct", F.lit(0.0))))).alias("_cells"), F.sum("RatePct").alias("_sum"))
    rows = with_scalars(rows, seen).withColumn("RowMeanPct", F.col("_sum") / F.size("_bands"))
    top = ranked(rows, n, by_desc("RowMeanPct"), "Origin")
    long = top.select("Rank", "Origin", "RowMeanPct", F.explode("_bands").alias("HourBand"), "_cells")
    long = long.withColumn("RatePct", F.coalesce(F.element_at("_cells", F.col("HourBand")), F.lit(0.0))).drop("_cells")
    best = Window.orderBy(by_desc("RatePct"), "Rank", "HourBand")  # n rows x bands
    return long.withColumn("IsHottest", F.row_number().over(best) == 1)


def anomaly_kpis(flights: DataFrame, monitor: DataFrame) -> DataFrame:
    """Flagged flights and their share, over- and under-burn, persistent segments."""
    k = flights.agg(
        F.count_if("IsAnomaly").alias("Anomalies"),
        (F.avg(F.col("IsAnomaly").cast("double")) * 100).alias("AnomalyPct"),
        F.count_if("IsOverburnAnomaly").alias("OverburnAnomalies"),
        F.count_if("IsUnderburnAnomaly").alias("UnderburnAnomalies"),
    )
    return with_scalars(k, monitor.agg(F.count_if("PersistenceFlag").alias("PersistentSegments")))


def metric_text(metric: Column, value: Column) -> Column:
    """A metric's value with its unit; shares as percent, missing as n/a."""
    number = F.format_number(value, 1)
    units = {"MeanBurnoff": "kg", "RMSE": "kg", "MeanTripTime": "sec", "MeanDistanceKm": "km"}
    unit = F.lit("")
    for name, u in units.items():
        unit = F.when(metric == name, F.lit(f" {u}")).otherwise(unit)
    percent = F.concat(F.regexp_replace(F.format_number(value * 100, 1), ",", ""), F.lit("%"))
    return F.when(value.isNull() | F.isnan(value), "n/a").when(metric.isin("MAPE", "MeanLoadFactor"), percent).otherwise(F.concat(number, unit))


def shared_models(results: DataFrame, predictions: DataFrame) -> DataFrame:
    """Models that are both in the results and among the predictions."""
    return results.select("Model").distinct().join(predictions.select("Model").distinct(), "Model", "left_semi")


def distance_error(df: DataFrame, error: str = "AbsError", distance: str = "RouteDistanceKm", q: float = 0.99) -> DataFrame:
    """How the error grows with distance, over the rows up to the error's
    ``q``-quantile: fitted slope, and mean error of the shortest and longest quarter."""
    rows = trim_above_quantile(df.select(error, distance), error, q)
    cuts = exact_quantiles(rows, distance, {"_short": 0.25, "_long": 0.75})
    out = with_scalars(rows, cuts).agg(
        F.count("*").alias("Rows"),
        F.regr_slope(error, distance).alias("SlopePerKm"),
        F.avg(F.when(F.col(distance) <= F.col("_short"), F.col(error))).alias("ShortMean"),
        F.avg(F.when(F.col(distance) >= F.col("_long"), F.col(error))).alias("LongMean"),
    )
    return out.withColumn("LongMinusShort", F.col("LongMean") - F.col("ShortMean"))
