"""Feature engineering (C1) and the route EDA summary.

One lazy projection over the raw fact: Catalyst fuses it into the scan's
whole-stage-codegen span; the only joins are the two bounded location
lookups for the route distance.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions import scalar as S
from ..functions.quantile import exact_quantiles
from ..sources.airports import route_distance, with_location


def positive_target(df: DataFrame, target: str = C.TARGET) -> DataFrame:
    """Keep rows with target > 0 (NULL target dropped, like pandas)."""
    return df.where(F.col(target) > 0)


def time_features(df: DataFrame, ts: str = "DepartureScheduled") -> DataFrame:
    """M2/M3: hour, month, year, day of week (0 = Monday), season."""
    return df.withColumns(
        {
            "DepartureHour": F.hour(ts),
            "DepartureMonth": F.month(ts),
            "DepartureYear": F.year(ts),
            "DepartureDayOfWeek": F.weekday(ts),
        }
    ).withColumn("Season", S.season("DepartureMonth"))


def route_features(df: DataFrame, airports: DataFrame, route: str = "ScheduledRoute") -> DataFrame:
    """M5-M7: origin/destination split and great-circle distance with the
    block-time fallback; ``DistanceImputed`` marks fallback rows."""
    out = route_distance(df, airports, route)
    return out.withColumns(
        {
            "Origin": S.route_part(route, 0),
            "Destination": S.route_part(route, 1),
            "DistanceImputed": F.col("_hav_km").isNull(),
            "RouteDistanceKm": F.coalesce(
                F.col("_hav_km"), F.col("BlockTimeScheduled") / 60 * F.lit(C.CRUISE_KMH)
            ),
        }
    ).drop("_hav_km")


def load_features(df: DataFrame) -> DataFrame:
    """M10/M11/M15/M16/M17 and the target-free interactions."""
    pax = F.col("Adults") + F.col("Children") + F.col("Infants")
    factor = S.type_factor("AircraftTypeGroup")
    return df.withColumns(
        {
            "TotalPassengers": pax,
            "LoadFactor": S.load_factor(pax, "AircraftCapacity"),
            "FreightPerKg": F.coalesce(F.col("Freight"), F.lit(0.0)),
            "WeightDelta": F.col("PlannedTOW") - F.col("PlannedZeroFuelWeight"),
            "TypeWeightInteraction": factor * F.col("PlannedTOW"),
            "TypeTripTimeInteraction": factor * F.col("PlannedTripTime"),
            "BaselineDelta": F.col("TeledyneRampWeight") - F.col("PlannedTOW"),
        }
    )


def burn_rate(df: DataFrame, target: str = C.TARGET) -> DataFrame:
    """Target per planned minute, minutes floored at 0.1."""
    minutes = S.clip(F.col("PlannedTripTime") / 60, lo=0.1)
    return df.withColumn("BurnoffPerMinute", F.col(target) / minutes)


def engineer_features(df: DataFrame, airports: DataFrame, with_target: bool = True) -> DataFrame:
    """Training variant (filters target > 0, adds the burn rate) or the
    scoring variant (no target-derived columns)."""
    out = positive_target(df) if with_target else df
    out = time_features(out)
    out = route_features(out, airports)
    out = load_features(out)
    if with_target:
        out = burn_rate(out)
    return out


def route_summary(eng: DataFrame, airports: DataFrame, target: str = C.TARGET) -> DataFrame:
    """Per route volume and target statistics plus both ends' location."""
    agg = eng.where(F.col("ScheduledRoute").isNotNull()).groupBy("ScheduledRoute").agg(
        F.count(target).alias("FlightCount"),
        F.avg(target).alias("MeanBurnoff"),
        F.stddev_samp(target).alias("StdBurnoff"),
        F.avg("PlannedTOW").alias("MeanTOW"),
        F.avg("PlannedTripTime").alias("MeanTripTime"),
        F.avg("LoadFactor").alias("MeanLoadFactor"),
        F.avg("RouteDistanceKm").alias("MeanDistanceKm"),
    )
    med = exact_quantiles(eng.where(F.col("ScheduledRoute").isNotNull()), target, {"MedianBurnoff": 0.5}, by=["ScheduledRoute"], write=True)
    agg = agg.join(med, "ScheduledRoute", "left")
    agg = agg.withColumns(
        {"Origin": S.route_part("ScheduledRoute", 0), "Destination": S.route_part("ScheduledRoute", 1)}
    )
    agg = with_location(agg, airports, "Origin", "Org")
    return with_location(agg, airports, "Destination", "Dst")
