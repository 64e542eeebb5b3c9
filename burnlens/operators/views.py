"""Table-returning versions of the dashboard's chart data (A20-A31, A38,
A39, A42, C19-C28). Every function returns a DataFrame; nothing is plotted
and nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from ..functions import scalar as S
from .sizing import with_scalars


def kpis(eng: DataFrame, target: str = C.TARGET) -> DataFrame:
    """Rows, distinct routes, mean target, distinct carriers."""
    return eng.agg(
        F.count(F.lit(1)).alias("Flights"),
        F.count_distinct("ScheduledRoute").alias("Routes"),
        F.avg(target).alias("MeanBurnoff"),
        F.count_distinct("Carrier").alias("Carriers"),
    )


def avoidable_share(flights: DataFrame) -> DataFrame:
    """Sum avoidable CO2 / max(sum actual CO2, 1)."""
    return flights.agg(
        F.coalesce(S.fixed_sum("AvoidableCO2_kg"), F.lit(0.0)).alias("TotalAvoidableCO2_kg"),
        F.coalesce(S.fixed_sum("ActualCO2_kg"), F.lit(0.0)).alias("TotalActualCO2_kg"),
    ).withColumn(
        "AvoidableShare",
        F.col("TotalAvoidableCO2_kg") / F.greatest(F.col("TotalActualCO2_kg"), F.lit(1.0)),
    )


def co2_by_type(flights: DataFrame) -> DataFrame:
    """Structural vs avoidable CO2 per aircraft type; share with a
    0 -> NULL denominator."""
    g = flights.where(F.col("AircraftTypeGroup").isNotNull()).groupBy("AircraftTypeGroup").agg(
        F.avg("StructuralCO2_kg").alias("MeanStructuralCO2_kg"),
        F.avg("AvoidableCO2_kg").alias("MeanAvoidableCO2_kg"),
        F.count(F.lit(1)).alias("Flights"),
    )
    tot = F.col("MeanStructuralCO2_kg") + F.col("MeanAvoidableCO2_kg")
    return g.withColumn("AvoidableSharePct", S.safe_div(F.col("MeanAvoidableCO2_kg") * 100, tot))


def co2_by_load_band(flights: DataFrame) -> DataFrame:
    """CO2 means and size per load-factor band."""
    return flights.groupBy("LoadFactorBand").agg(
        F.avg("StructuralCO2_kg").alias("MeanStructuralCO2_kg"),
        F.avg("AvoidableCO2_kg").alias("MeanAvoidableCO2_kg"),
        F.avg("ActualCO2_kg").alias("MeanActualCO2_kg"),
        F.count(F.lit(1)).alias("Flights"),
    )


def threshold_shares(flights: DataFrame) -> DataFrame:
    """Share of rows with burn >= 10,000 kg, distance >= 3,000 km and
    |segment z| >= 2.5 (percent)."""
    def pct(cond):
        return F.avg(S.is_true(cond).cast("double")) * 100

    return flights.agg(
        pct(F.col("ActualBurn_kg") >= 10000).alias("HeavyBurnPct"),
        pct(F.col("RouteDistanceKm") >= 3000).alias("LongHaulPct"),
        pct(F.abs("ResidualZ_segment") >= C.ANOMALY_Z).alias("BeyondZPct"),
    )


def airport_layer(route_err: DataFrame, metric: str = "MeanBurnoff", min_flights: int = 5) -> DataFrame:
    """Per origin airport: mean of ``metric`` over qualifying routes,
    total flights and the marker size sum^0.45 * 2."""
    re = route_err.where(
        (F.col("FlightCount") >= min_flights)
        & F.col("OrgLat").isNotNull() & F.col("OrgLon").isNotNull()
        & F.col("DstLat").isNotNull() & F.col("DstLon").isNotNull()
    )
    g = re.groupBy("Origin", "OrgLat", "OrgLon", "OrgCity").agg(
        F.avg(metric).alias("MetricMean"),
        F.sum("FlightCount").alias("Flights"),
    )
    return g.withColumn("MarkerSize", F.pow(F.col("Flights"), 0.45) * 2)


def route_arcs(route_err: DataFrame, min_flights: int = 5, n: int = 500) -> DataFrame:
    """The n busiest qualifying routes as arcs with a midpoint
    lifted by 2 degrees of latitude (top-k, key tie-break)."""
    re = route_err.where(
        (F.col("FlightCount") >= min_flights)
        & F.col("OrgLat").isNotNull() & F.col("OrgLon").isNotNull()
        & F.col("DstLat").isNotNull() & F.col("DstLon").isNotNull()
    )
    top = re.orderBy(F.desc("FlightCount"), "ScheduledRoute").limit(n)
    return top.select(
        "ScheduledRoute", "FlightCount", "OrgLat", "OrgLon", "DstLat", "DstLon",
        ((F.col("OrgLat") + F.col("DstLat")) / 2 + 2).alias("MidLat"),
        ((F.col("OrgLon") + F.col("DstLon")) / 2).alias("MidLon"),
    )


def routes_flown_by(route_err: DataFrame, eng: DataFrame, types: DataFrame) -> DataFrame:
    """Routes with at least one flight by one of ``types`` (a semi join;
    the type list is a frame, so its size never matters)."""
    from .sizing import measured_broadcast

    flown = (
        eng.join(measured_broadcast(types), "AircraftTypeGroup", "left_semi")
        .where(F.col("ScheduledRoute").isNotNull()).select("ScheduledRoute").distinct()
    )
    return route_err.join(flown, "ScheduledRoute", "left_semi")


def top_types_by_volume(eng: DataFrame, k: int = 3) -> DataFrame:
    """The k most frequent aircraft types (name tie-break)."""
    return (
        eng.where(F.col("AircraftTypeGroup").isNotNull())
        .groupBy("AircraftTypeGroup").agg(F.count(F.lit(1)).alias("_n"))
        .orderBy(F.desc("_n"), "AircraftTypeGroup").limit(k).select("AircraftTypeGroup")
    )


def airport_drilldown(route_err: DataFrame, n: int = 12) -> DataFrame:
    """For every city, the n busiest routes touching it (origin or
    destination city), with its rank. The window ranks the routes of one
    city, never flight rows."""
    ends = route_err.select(F.col("OrgCity").alias("City"), "ScheduledRoute", "FlightCount", "MeanBurnoff", "MAPE").unionByName(
        route_err.select(F.col("DstCity").alias("City"), "ScheduledRoute", "FlightCount", "MeanBurnoff", "MAPE")
    ).where(F.col("City").isNotNull()).dropDuplicates(["City", "ScheduledRoute"])
    w = Window.partitionBy("City").orderBy(F.desc("FlightCount"), "ScheduledRoute")
    return ends.withColumn("Rank", F.row_number().over(w)).where(F.col("Rank") <= n)


def busiest_routes(route_err: DataFrame, n: int = 15) -> DataFrame:
    """C22 default view: the n busiest routes."""
    return route_err.orderBy(F.desc("FlightCount"), "ScheduledRoute").limit(n).select(
        "ScheduledRoute", "FlightCount", "MeanBurnoff"
    )


def hour_hotspots(segment_opp: DataFrame, n: int = 15) -> DataFrame:
    """Airport x hour anomaly-rate matrix (percent, missing cells 0),
    summarised per origin: row mean over the hour bands present, hottest
    band and its rate; the n origins with the highest row mean."""
    ah = segment_opp.where(F.col("SegmentType") == "Airport × Hour").select(
        S.segment_part("SegmentName", 0).alias("Origin"),
        S.segment_part("SegmentName", 1).alias("HourBand"),
        (F.col("AnomalyRate") * 100).alias("RatePct"),
    )
    cells = ah.groupBy("Origin", "HourBand").agg(F.avg("RatePct").alias("RatePct"))
    nb = cells.agg(F.count_distinct("HourBand").alias("_bands"))
    per = cells.groupBy("Origin").agg(
        F.sum(F.coalesce("RatePct", F.lit(0.0))).alias("_sum"),
        F.max(F.coalesce("RatePct", F.lit(0.0))).alias("MaxRatePct"),
    )
    per = with_scalars(per, nb).withColumn("RowMeanPct", F.col("_sum") / F.col("_bands"))
    w_best = cells.withColumn("_v", F.coalesce("RatePct", F.lit(0.0)))
    w = Window.partitionBy("Origin").orderBy(F.desc("_v"), "HourBand")
    hottest = w_best.withColumn("_r", F.row_number().over(w)).where(F.col("_r") == 1).select(
        "Origin", F.col("HourBand").alias("HottestBand")
    )
    top = per.join(hottest, "Origin").orderBy(F.desc("RowMeanPct"), "Origin").limit(n)
    return top.select("Origin", "RowMeanPct", "HottestBand", "MaxRatePct")


def what_if(eng: DataFrame, loads: tuple = (0.6, 0.8, 0.95), econ: C.Economics = C.Economics()) -> DataFrame:
    """C19 re-aimed as a table: for every observed (type, route) and each
    scenario load factor, the expected burn = route mean + (load - mean
    load) * cov/var (>= 5 rows) else type mean + (load - type mean load) *
    3000; floored at 500; CO2, CO2 per estimated passenger, spread, distance."""
    e = eng.where(F.col("AircraftTypeGroup").isNotNull() & F.col("ScheduledRoute").isNotNull())
    rt = e.groupBy("AircraftTypeGroup", "ScheduledRoute").agg(
        F.count(F.lit(1)).alias("_n"),
        F.avg(C.TARGET).alias("_rb"),
        F.avg("LoadFactor").alias("_rl"),
        F.covar_samp("LoadFactor", C.TARGET).alias("_cov"),
        F.var_samp("LoadFactor").alias("_var"),
        F.stddev_samp(C.TARGET).alias("_rs"),
        F.avg("RouteDistanceKm").alias("_rd"),
    )
    ty = e.groupBy("AircraftTypeGroup").agg(
        F.avg(C.TARGET).alias("_tb"),
        F.avg("LoadFactor").alias("_tl"),
        F.stddev_samp(C.TARGET).alias("_ts"),
        F.avg("RouteDistanceKm").alias("_td"),
        F.avg("AircraftCapacity").alias("_cap"),
    )
    grid = rt.join(ty, "AircraftTypeGroup").select(
        "*", F.explode(F.array(*[F.lit(float(x)) for x in loads])).alias("LoadFactorScenario")
    )
    lf = F.col("LoadFactorScenario")
    enough = F.col("_n") >= C.WHAT_IF_MIN_ROWS
    slope = F.when(F.col("_var") > 0, F.col("_cov") / F.col("_var")).otherwise(F.lit(500.0))
    est = F.when(enough, F.col("_rb") + (lf - F.col("_rl")) * slope).otherwise(
        F.col("_tb") + (lf - F.col("_tl")) * C.WHAT_IF_KG_PER_LOAD
    )
    est = F.greatest(est, F.lit(C.WHAT_IF_FLOOR_KG))
    pax = (lf * F.col("_cap")).cast("long")
    co2 = est * econ.co2_per_kg
    return grid.select(
        "AircraftTypeGroup", "ScheduledRoute", "LoadFactorScenario",
        est.alias("PredictedBurnoff_kg"),
        co2.alias("CO2_kg"),
        pax.alias("EstPassengers"),
        (co2 / F.greatest(pax, F.lit(1))).alias("CO2PerPax_kg"),
        F.when(enough, F.col("_rs")).otherwise(F.col("_ts")).alias("StdBurnoff_kg"),
        F.when(enough, F.col("_rd")).otherwise(F.col("_td")).alias("DistanceKm"),
        F.when(enough, F.col("_n")).otherwise(F.lit(0)).alias("HistoricalFlights"),
    )


def fleet_comparison(eng: DataFrame, min_rows: int = 3, econ: C.Economics = C.Economics()) -> DataFrame:
    """C20: per route and type with at least ``min_rows`` flights: mean burn
    and CO2, rounded to whole kg (half-even)."""
    g = eng.where(F.col("AircraftTypeGroup").isNotNull() & F.col("ScheduledRoute").isNotNull()).groupBy(
        "ScheduledRoute", "AircraftTypeGroup"
    ).agg(F.count(F.lit(1)).alias("Flights"), F.avg(C.TARGET).alias("_b"))
    return g.where(F.col("Flights") >= min_rows).select(
        "ScheduledRoute", "AircraftTypeGroup", "Flights",
        F.bround("_b", 0).alias("AvgBurnoff_kg"),
        F.bround(F.col("_b") * econ.co2_per_kg, 0).alias("CO2_kg"),
    )


# ---------------------------------------------------------------------------
# Fallbacks when the stage-6 tables are missing


def fallback_flights(df: DataFrame, econ: C.Economics = C.Economics()) -> DataFrame:
    """Flight layer from residual diagnostics only: two-sigma rule on
    the absolute error, sign-based type, right-closed dashboard bands."""
    st = df.agg(F.avg("AbsError").alias("_m"), F.stddev_samp("AbsError").alias("_s"))
    out = with_scalars(df, st)
    exc_pos = S.positive_part("ExcessBurn_kg")
    return out.select(
        "*",
        F.col("PredictedBurn_kg").alias("Pred_kg"),
        (exc_pos * econ.co2_per_kg).alias("AvoidableCO2_kg"),
        (F.col("PredictedBurn_kg") * econ.co2_per_kg).alias("StructuralCO2_kg"),
        (exc_pos * econ.price_per_kg).alias("AvoidableFuelCost_eur"),
        S.is_true(F.col("AbsError") > F.col("_m") + 2 * F.col("_s")).alias("IsAnomaly"),
        F.when(S.is_true(F.col("ExcessBurn_kg") > 0), "Over-consumption").otherwise("Under-consumption").alias("AnomalyType"),
        F.coalesce(S.cut_edges("DepartureHour", C.FALLBACK_HOUR_EDGES, C.FALLBACK_HOUR_LABELS), F.lit("nan")).alias("DepartureHourBand"),
        F.coalesce(S.cut_edges("LoadFactor", C.FALLBACK_LOAD_EDGES, C.FALLBACK_LOAD_LABELS), F.lit("nan")).alias("LoadFactorBand"),
        F.coalesce(S.cut_edges("RouteDistanceKm", C.FALLBACK_DIST_EDGES, C.FALLBACK_DIST_LABELS), F.lit("nan")).alias("DistanceBand"),
    ).drop("_m", "_s")


def fallback_route_opportunity(ff: DataFrame) -> DataFrame:
    """Cost sum, CO2 sum / 1000, volume-weighted score (uses actual burn
    for the count; see README on the missing column)."""
    g = ff.where(F.col("ScheduledRoute").isNotNull()).groupBy("ScheduledRoute").agg(
        F.count(F.lit(1)).alias("FlightCount"),
        F.avg("ExcessBurn_kg").alias("MeanExcessBurn"),
        F.coalesce(S.fixed_sum("AvoidableFuelCost_eur"), F.lit(0.0)).alias("AnnualAvoidableCost_eur"),
        (F.coalesce(S.fixed_sum("AvoidableCO2_kg"), F.lit(0.0)) / 1000).alias("AnnualAvoidableCO2_t"),
        F.avg(F.col("IsAnomaly").cast("double")).alias("AnomalyRate"),
        F.avg("RouteDistanceKm").alias("MeanDistanceKm"),
        F.avg("LoadFactor").alias("MeanLoadFactor"),
    )
    return g.withColumn("OpportunityScore", F.col("AnnualAvoidableCost_eur") * F.log1p("FlightCount"))


def fallback_segment_opportunity(ff: DataFrame) -> DataFrame:
    """By aircraft type only."""
    g = ff.where(F.col("AircraftTypeGroup").isNotNull()).groupBy(F.col("AircraftTypeGroup").alias("SegmentName")).agg(
        F.count(F.lit(1)).alias("FlightCount"),
        F.avg("ExcessBurn_kg").alias("MeanExcessBurn"),
        F.coalesce(S.fixed_sum("AvoidableFuelCost_eur"), F.lit(0.0)).alias("AnnualAvoidableCost_eur"),
        (F.coalesce(S.fixed_sum("AvoidableCO2_kg"), F.lit(0.0)) / 1000).alias("AnnualAvoidableCO2_t"),
        F.avg(F.col("IsAnomaly").cast("double")).alias("AnomalyRate"),
    )
    return g.withColumns(
        {"SegmentType": F.lit("Aircraft"), "OpportunityScore": F.col("AnnualAvoidableCost_eur") * F.log1p("FlightCount")}
    )


def fallback_anomaly_monitor(ff: DataFrame) -> DataFrame:
    """Per route; persistent when the anomaly rate beats the median
    route rate (exact median over the route table)."""
    from ..functions.quantile import exact_quantiles

    g = ff.where(F.col("ScheduledRoute").isNotNull()).groupBy(F.col("ScheduledRoute").alias("SegmentName")).agg(
        F.count(F.lit(1)).alias("FlightCount"),
        F.count_if("IsAnomaly").alias("AnomalyCount"),
        F.avg(F.col("IsAnomaly").cast("double")).alias("AnomalyRate"),
        F.avg("ExcessBurn_kg").alias("MeanExcessBurn"),
    )
    med = exact_quantiles(g, "AnomalyRate", {"_med": 0.5})
    return with_scalars(g, med).select(
        "*", F.lit("Route").alias("SegmentType"), S.is_true(F.col("AnomalyRate") > F.col("_med")).alias("PersistenceFlag")
    ).drop("_med")


def fallback_scenarios(route_fb: DataFrame) -> DataFrame:
    """The 25 % scenario over the fallback route table."""
    return route_fb.select(
        F.lit("Route").alias("SegmentType"),
        F.col("ScheduledRoute").alias("SegmentName"),
        F.lit(C.SCENARIOS[0][0]).alias("Scenario"),
        (F.col("AnnualAvoidableCost_eur") * C.SCENARIOS[0][1]).alias("SavingsPotential_eur"),
        (F.col("AnnualAvoidableCO2_t") * C.SCENARIOS[0][1]).alias("SavingsPotential_CO2_t"),
    )
