"""Money / emissions layer and flight-level anomaly labels (C6, C7, C9, C10,
C17, C18, A40, A41, M19-M26).

Everything is a projection over the scored fact; the only aggregates are
global 1-row frames (count, mean, pop std, exact quantile) that are
cross-joined by broadcast (a 1-row frame has a proven size).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions import scalar as S
from ..functions.quantile import exact_quantiles
from .sizing import with_scalars


def flight_residuals(df: DataFrame, pred: str = "PredictedBurn_kg", actual: str = C.TARGET) -> DataFrame:
    """M20 in the stage-6 naming."""
    r = F.col(pred) - F.col(actual)
    return df.withColumns(
        {
            "ActualBurn_kg": F.col(actual),
            "Residual_kg": r,
            "AbsError_kg": F.abs(r),
            "ExcessBurn_kg": -r,
        }
    )


def emissions_and_cost(df: DataFrame, econ: C.Economics = C.Economics()) -> DataFrame:
    """C6 (M19, M21, M22): excess %, per-km and per-pax-km intensities, CO2,
    avoidable fuel cost, planning gap and carry penalty."""
    pred, act, exc, km = (F.col(c) for c in ("PredictedBurn_kg", "ActualBurn_kg", "ExcessBurn_kg", "RouteDistanceKm"))
    pax = F.col("TotalPassengers")
    seat_km = pax * km
    per_pax_ok = S.is_true((pax > 0) & (seat_km > 0))
    excess_pos = S.positive_part(exc)
    proxy = F.col("TeledyneRampWeight") - F.col("PlannedZeroFuelWeight")
    gap = proxy - pred
    return df.withColumns(
        {
            "ExcessBurnPct_pred": S.safe_div(exc, pred) * 100,
            "ExcessBurnPct_actual": S.safe_div(exc, act) * 100,
            "ActualBurnPerKm": S.safe_div(act, km),
            "PredictedBurnPerKm": S.safe_div(pred, km),
            "BurnPerPaxKm_actual": F.when(per_pax_ok, S.safe_div(act * 1000, seat_km)),
            "BurnPerPaxKm_pred": F.when(per_pax_ok, S.safe_div(pred * 1000, seat_km)),
            "StructuralCO2_kg": pred * econ.co2_per_kg,
            "ActualCO2_kg": act * econ.co2_per_kg,
            "AvoidableCO2_kg": excess_pos * econ.co2_per_kg,
            "AvoidableFuelCost_eur": excess_pos * econ.price_per_kg,
            "PlannedFuelProxy_kg": proxy,
            "OpsPlanningGap_kg": gap,
            "CarryPenaltyCost_eur": S.positive_part(gap) * econ.carry_penalty * econ.price_per_kg,
        }
    ).withColumn("IntensityGapPerKm", F.col("ActualBurnPerKm") - F.col("PredictedBurnPerKm"))


def bands(df: DataFrame) -> DataFrame:
    """C7 (M12-M14, M23): hour / load / distance bands and composite keys."""
    return df.withColumns(
        {
            "DepartureHourBand": S.hour_band("DepartureHour"),
            "LoadFactorBand": S.load_band("LoadFactor"),
            "DistanceBand": S.distance_band("RouteDistanceKm"),
        }
    ).withColumns(
        {
            "RouteAircraft": F.concat(
                F.col("ScheduledRoute"), F.lit(C.SEGMENT_SEP), F.coalesce(F.col("AircraftTypeGroup").cast("string"), F.lit("nan"))
            ),
            "AirportHour": F.concat(
                F.coalesce(F.col("Origin").cast("string"), F.lit("nan")), F.lit(C.SEGMENT_SEP), F.col("DepartureHourBand")
            ),
        }
    )


def data_issue_cut(df: DataFrame, rules: C.AnomalyRules = C.AnomalyRules()) -> DataFrame:
    """1-row frame with ``_abs_cut``, the exact 99.5 % quantile of the absolute error."""
    return exact_quantiles(df, "AbsError_kg", {"_abs_cut": rules.quantile})


def classify_anomalies(df: DataFrame, rules: C.AnomalyRules = C.AnomalyRules(), cut: DataFrame | None = None) -> DataFrame:
    """C9 (M24, M25): two-sided flags on the segment z-score, the 3-way type,
    the data-issue rule (abs error above its exact 99.5 % quantile, tiny burn
    or tiny distance) and the priority-cascade issue class. ``cut`` is
    ``data_issue_cut(df)``, if that has been written already."""
    q = data_issue_cut(df, rules) if cut is None else cut
    z = F.col("ResidualZ_segment")
    out = with_scalars(df, q).withColumns(
        {
            "IsOverburnAnomaly": S.is_true(z < -rules.z),
            "IsUnderburnAnomaly": S.is_true(z > rules.z),
        }
    )
    issue = (
        S.is_true(F.col("AbsError_kg") > F.col("_abs_cut"))
        | S.is_true(F.col("ActualBurn_kg") < rules.min_burn)
        | S.is_true(F.col("RouteDistanceKm") < rules.min_km)
    )
    out = out.withColumns(
        {
            "IsAnomaly": F.col("IsOverburnAnomaly") | F.col("IsUnderburnAnomaly"),
            "AnomalyType": F.when(F.col("IsOverburnAnomaly"), "Over-consumption")
            .when(F.col("IsUnderburnAnomaly"), "Under-consumption")
            .otherwise("Normal"),
            "PossibleDataIssue": issue,
        }
    )
    cls = (
        F.when(F.col("PossibleDataIssue"), "Possible data-quality issue")
        .when(S.is_true(F.col("OpsPlanningGap_kg") > rules.planning_gap), "Planning conservatism / fuel policy")
        .when(F.col("IsOverburnAnomaly"), "Operational over-burn")
        .when(F.col("IsUnderburnAnomaly"), "Favourable conditions / under-burn")
        .otherwise("Normal")
    )
    return out.withColumn("LikelyIssueClass", cls).drop("_abs_cut")


def annual_scale(df: DataFrame, econ: C.Economics = C.Economics()) -> DataFrame:
    """1-row frame with ``ScaleToAnnual`` = annual flights / rows."""
    return df.agg((F.lit(float(econ.annual_flights)) / F.count(F.lit(1))).alias("ScaleToAnnual"))


def annualise(df: DataFrame, econ: C.Economics = C.Economics(), scale: DataFrame | None = None) -> DataFrame:
    """Per-flight annualised avoidable CO2 (t) and cost (EUR). ``scale`` is
    ``annual_scale(df)``, if that has been written already."""
    out = with_scalars(df, annual_scale(df, econ) if scale is None else scale)
    return out.withColumns(
        {
            "AnnualisedAvoidableCO2_t": F.col("AvoidableCO2_kg") * F.col("ScaleToAnnual") / 1000,
            "AnnualisedAvoidableCost_eur": F.col("AvoidableFuelCost_eur") * F.col("ScaleToAnnual"),
        }
    )


# The exports have these columns in this order.
FLIGHT_COLUMNS = [
    "ScheduledRoute", "Carrier", "AOCDescription", "AircraftTypeGroup",
    "Origin", "Destination", "Season", "DepartureYear", "DepartureMonth",
    "DepartureHour", "DepartureHourBand", "LoadFactorBand", "DistanceBand",
    "ActualBurn_kg", "PredictedBurn_kg", "BaselinePred_kg",
    "Residual_kg", "AbsError_kg", "ExcessBurn_kg",
    "ExcessBurnPct_pred", "ExcessBurnPct_actual",
    "ActualBurnPerKm", "PredictedBurnPerKm", "IntensityGapPerKm",
    "BurnPerPaxKm_actual", "BurnPerPaxKm_pred",
    "ActualCO2_kg", "StructuralCO2_kg", "AvoidableCO2_kg",
    "AvoidableFuelCost_eur", "CarryPenaltyCost_eur",
    "PlannedFuelProxy_kg", "OpsPlanningGap_kg",
    "ResidualZ_global", "ResidualZ_segment", "SegmentBasis",
    "IsAnomaly", "IsOverburnAnomaly", "IsUnderburnAnomaly",
    "AnomalyType", "LikelyIssueClass", "PossibleDataIssue",
    "AnnualisedAvoidableCO2_t", "AnnualisedAvoidableCost_eur",
]

ANOMALY_COLUMNS = [
    "ScheduledRoute", "AircraftTypeGroup", "Carrier", "Origin", "Destination",
    "Season", "DepartureHourBand", "LoadFactor", "RouteDistanceKm",
    "ActualBurn_kg", "PredictedBurn_kg", "ExcessBurn_kg", "Residual_kg",
    "AnomalyType", "AnomalyScore", "LikelyIssueClass", "OpsPlanningGap_kg",
]


def anomaly_list(flights: DataFrame) -> DataFrame:
    """C17: flagged flights with score = |segment z|."""
    return flights.where(F.col("IsAnomaly")).withColumn("AnomalyScore", F.abs("ResidualZ_segment")).select(
        *ANOMALY_COLUMNS
    )


def annual_totals(flights: DataFrame, econ: C.Economics = C.Economics()) -> DataFrame:
    """Annualised cost, CO2 and carry penalty (1 row)."""
    return flights.agg(
        (S.fixed_sum("AvoidableFuelCost_eur") * F.lit(float(econ.annual_flights)) / F.count(F.lit(1))).alias("AnnualAvoidableCost_eur"),
        (S.fixed_sum("AvoidableCO2_kg") * F.lit(float(econ.annual_flights)) / F.count(F.lit(1)) / 1000).alias("AnnualAvoidableCO2_t"),
        (S.fixed_sum("CarryPenaltyCost_eur") * F.lit(float(econ.annual_flights)) / F.count(F.lit(1))).alias("AnnualCarryPenalty_eur"),
    )


def anomaly_kpis(flights: DataFrame) -> DataFrame:
    """Flagged count / share and over- / under-burn counts (1 row)."""
    return flights.agg(
        F.count_if("IsAnomaly").alias("AnomalyCount"),
        F.avg(F.col("IsAnomaly").cast("double")).alias("AnomalyShare"),
        F.count_if("IsOverburnAnomaly").alias("OverburnCount"),
        F.count_if("IsUnderburnAnomaly").alias("UnderburnCount"),
        F.count_if("PossibleDataIssue").alias("DataIssueCount"),
        F.count(F.lit(1)).alias("Flights"),
    )


def value_summary(flights: DataFrame, primary_model: str = "GroupMean", econ: C.Economics = C.Economics()) -> DataFrame:
    """The key/value metric table as ``(Metric, Value, ValueText)``.

    Everything is one aggregate pass; the long shape comes from ``stack``.
    """
    e = F.col("PredictedBurn_kg") - F.col("ActualBurn_kg")
    b = F.col("BaselinePred_kg") - F.col("ActualBurn_kg")
    n = F.count(F.lit(1))
    scale = F.lit(float(econ.annual_flights)) / n
    agg = flights.agg(
        F.sqrt(F.avg(b * b)).alias("base_rmse"),
        F.sqrt(F.avg(e * e)).alias("model_rmse"),
        (F.sum("AvoidableFuelCost_eur") * scale).alias("cost"),
        (F.sum("AvoidableCO2_kg") * scale / 1000).alias("co2"),
        (F.sum("CarryPenaltyCost_eur") * scale).alias("carry"),
    )
    buffer = F.lit(C.BUFFER_Z) * F.greatest(F.col("base_rmse") - F.col("model_rmse"), F.lit(0.0))
    fuel_t = buffer * econ.carry_penalty * econ.annual_flights / 1000
    ets = F.col("co2") * econ.ets_per_tonne
    metrics = [
        ("Baseline RMSE (kg)", F.bround("base_rmse", 1)),
        ("Model RMSE (kg)", F.bround("model_rmse", 1)),
        ("Buffer reduction per flight (kg)", F.bround(buffer, 1)),
        ("Annual buffer fuel saved (tonnes)", F.bround(fuel_t, 0)),
        ("Annual buffer cost savings (EUR)", F.bround(fuel_t * 1000 * econ.price_per_kg, 0)),
        ("Annual buffer CO2 avoided (tonnes)", F.bround(fuel_t * econ.co2_per_kg, 0)),
        ("Annual avoidable operational cost (EUR)", F.bround("cost", 0)),
        ("Annual avoidable operational CO2 (tonnes)", F.bround("co2", 0)),
        ("Annual planning carry penalty (EUR)", F.bround("carry", 0)),
        ("Annual ETS savings on avoidable CO2 (EUR)", F.bround(ets, 0)),
        ("Total annual value (EUR)", F.bround(F.col("cost") + F.col("carry") + ets, 0)),
    ]
    cols = [F.struct(F.lit(i + 1).alias("Ord"), F.lit(m).alias("Metric"), v.cast("double").alias("Value"),
                     F.lit(None).cast("string").alias("ValueText")) for i, (m, v) in enumerate(metrics)]
    head = F.struct(F.lit(0).alias("Ord"), F.lit("Primary model").alias("Metric"),
                    F.lit(None).cast("double").alias("Value"), F.lit(primary_model).alias("ValueText"))
    return agg.select(F.inline(F.array(head, *cols)))
