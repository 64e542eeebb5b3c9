"""Residuals, error metrics and diagnostics.

Every metric is one aggregate pass with algebraic (partially aggregated)
functions: sums, counts and sums of squares. Nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions import scalar as S
from ..functions.quantile import exact_quantiles
from .sizing import with_scalars


def residuals(df: DataFrame, pred: str = "PredictedBurn_kg", actual: str = C.TARGET) -> DataFrame:
    """residual = pred - actual (over-burn is negative), abs / relative
    error (actual floored at 1), excess = -residual, excess % of pred."""
    r = F.col(pred) - F.col(actual)
    return df.withColumns(
        {
            "Residual": r,
            "AbsError": F.abs(r),
            "RelError": F.abs(r) / S.clip(actual, lo=1.0),
            "ExcessBurn_kg": -r,
            "ExcessBurnPct": -r / S.clip(pred, lo=1.0) * 100,
        }
    )


def metric_exprs(y: str, yhat: str, prefix: str = "") -> list:
    """RMSE, MAE, MAPE (% of |y|, sklearn eps), R^2 as aggregate expressions."""
    e = F.col(yhat) - F.col(y)
    eps = 2.220446049250313e-16  # numpy float64 epsilon, sklearn's MAPE floor
    ss_res = F.sum(e * e)
    ss_tot = F.var_pop(y) * F.count(y)  # centred as it goes: raw squares would cancel
    return [
        F.sqrt(F.avg(e * e)).alias(f"{prefix}RMSE"),
        F.avg(F.abs(e)).alias(f"{prefix}MAE"),
        (F.avg(F.abs(e) / F.greatest(F.abs(F.col(y)), F.lit(eps))) * 100).alias(f"{prefix}MAPE"),
        (F.lit(1.0) - ss_res / ss_tot).alias(f"{prefix}R2"),
    ]


def model_metrics(df: DataFrame, y: str, yhat: str) -> DataFrame:
    """A17 on one prediction column, rounded like the reference (2, 2, 3, 4)."""
    rows = df.where(F.col(y).isNotNull() & F.col(yhat).isNotNull())
    m = rows.agg(*metric_exprs(y, yhat))
    return m.select(
        F.bround("RMSE", 2).alias("RMSE"), F.bround("MAE", 2).alias("MAE"),
        F.bround("MAPE", 3).alias("MAPE"), F.bround("R2", 4).alias("R2"),
    )


def metrics_long(df: DataFrame, y: str, preds: dict[str, str]) -> DataFrame:
    """A19/ML11: one row per label from a long ``(label, y, yhat)`` stack."""
    stacked = None
    for label, c in preds.items():
        part = df.select(F.lit(label).alias("Label"), F.col(y).alias("_y"), F.col(c).alias("_yhat"))
        stacked = part if stacked is None else stacked.unionByName(part)
    stacked = stacked.where(F.col("_y").isNotNull() & F.col("_yhat").isNotNull())
    m = stacked.groupBy("Label").agg(*metric_exprs("_y", "_yhat"))
    return m.select(
        "Label", F.bround("RMSE", 2).alias("RMSE"), F.bround("MAPE", 3).alias("MAPE"),
        F.bround("R2", 4).alias("R2"),
    )


def within_tolerance(df: DataFrame, y: str, yhat: str, tol: float = 0.05) -> DataFrame:
    """Share of rows with |e| / max(|y|, 1) <= tol, and mean bias."""
    e = F.col(yhat) - F.col(y)
    rel = F.abs(e) / F.greatest(F.abs(F.col(y)), F.lit(1.0))
    return df.agg(
        F.avg(F.when(rel <= tol, 1.0).otherwise(0.0)).alias("WithinTolShare"),
        F.avg(e).alias("MeanBias"),
        F.count(F.lit(1)).alias("Rows"),
    )


def route_error(df: DataFrame, airports: DataFrame) -> DataFrame:
    """C4/A2: per-route error table with geography; routes whose origin has
    no coordinates are dropped (P3)."""
    from ..sources.airports import with_location

    agg = df.where(F.col("ScheduledRoute").isNotNull()).groupBy("ScheduledRoute").agg(
        F.count(C.TARGET).alias("FlightCount"),
        F.avg(C.TARGET).alias("MeanBurnoff"),
        F.avg("PredictedBurn_kg").alias("MeanPred"),
        F.sqrt(F.avg(F.col("Residual") * F.col("Residual"))).alias("RMSE"),
        F.avg("RelError").alias("MAPE"),
        F.avg("AbsError").alias("MeanAbsError"),
        F.avg("PlannedTripTime").alias("MeanTripTime"),
        F.avg("LoadFactor").alias("MeanLoadFactor"),
        F.avg("RouteDistanceKm").alias("MeanDistKm"),
    )
    agg = agg.withColumns({"Origin": S.route_part("ScheduledRoute", 0), "Destination": S.route_part("ScheduledRoute", 1)})
    agg = with_location(agg, airports, "Origin", "Org").drop("OrgCountry")
    agg = with_location(agg, airports, "Destination", "Dst").drop("DstCountry")
    return agg.where(F.col("OrgLat").isNotNull() & F.col("OrgLon").isNotNull())


def worst_routes(route_err: DataFrame, n: int = 10) -> DataFrame:
    """Top-n by RMSE with a key tie-break (TakeOrderedAndProject)."""
    return route_err.orderBy(F.desc("RMSE"), F.asc("ScheduledRoute")).limit(n).select(
        "ScheduledRoute", "FlightCount", "RMSE", "MAPE", "MeanBurnoff"
    )


def bias_report(df: DataFrame, residual: str = "Residual") -> DataFrame:
    """Residual mean and sample std per aircraft type, season and
    year, stacked with a ``Group`` label; one shared scan through grouping sets."""
    keyed = df.select(
        F.col("AircraftTypeGroup").cast("string").alias("aircraft_type"),
        F.col("Season").cast("string").alias("season"),
        F.col("DepartureYear").cast("string").alias("year"),
        F.col(residual).alias("_r"),
    )
    g = keyed.groupingSets([["aircraft_type"], ["season"], ["year"]], "aircraft_type", "season", "year").agg(
        F.grouping_id().alias("_gid"),
        F.bround(F.avg("_r"), 2).alias("mean"),
        F.bround(F.stddev_samp("_r"), 2).alias("std"),
    )
    # grouping_id bits: aircraft_type=4, season=2, year=1 (bit set = not grouped)
    label = (
        F.when(F.col("_gid") == 3, F.lit("aircraft_type"))
        .when(F.col("_gid") == 5, F.lit("season"))
        .otherwise(F.lit("year"))
    )
    key = F.coalesce("aircraft_type", "season", "year")
    return g.select(label.alias("Group"), key.alias("Key"), "mean", "std").where(F.col("Key").isNotNull())


def equal_width_bins(df: DataFrame, x: str, bins: int = 10, name: str = "Bin") -> DataFrame:
    """M8: ``pd.cut(x, bins)``: equal width over [min, max], right-closed,
    lowest edge widened by 0.1 % of the range; adds the bin number
    (1..bins) and its midpoint. The 1-row min/max is cross-joined."""
    mm = df.agg(F.min(x).alias("_mn"), F.max(x).alias("_mx"))
    out = with_scalars(df, mm)
    rng = F.col("_mx") - F.col("_mn")
    w = rng / bins
    # pandas: edges linspace(mn, mx, bins+1); first edge lowered by 0.1% of range
    idx = F.ceil((F.col(x) - F.col("_mn")) / w)
    b = F.when(rng == 0, F.lit(None)).otherwise(F.least(F.greatest(idx, F.lit(1)), F.lit(bins)))
    lo_edge = F.col("_mn") + (F.col(name) - 1) * w
    hi_edge = F.col("_mn") + F.col(name) * w
    lo_adj = F.when(F.col(name) == 1, F.col("_mn") - rng * 0.001).otherwise(lo_edge)
    return (
        out.withColumn(name, b.cast("int"))
        .withColumn(f"{name}Mid", (lo_adj + hi_edge) / 2)
        .drop("_mn", "_mx")
    )


def bias_by_bin(df: DataFrame, x: str = "LoadFactor", residual: str = "Residual", bins: int = 10) -> DataFrame:
    """A4: mean residual per equal-width bin (observed bins only)."""
    b = equal_width_bins(df.where(F.col(x).isNotNull()), x, bins)
    return b.groupBy("Bin").agg(
        F.first("BinMid").alias("BinMid"),
        F.avg(residual).alias("MeanResidual"),
        F.count(F.lit(1)).alias("Rows"),
    )


def monthly_drift(df: DataFrame, ts: str = "DepartureScheduled", residual: str = "Residual") -> DataFrame:
    """A5: mean residual per calendar month."""
    return df.groupBy(S.month_label(ts).alias("Month")).agg(
        F.avg(residual).alias("MeanResidual"), F.count(F.lit(1)).alias("Rows")
    )


def monthly_volume(df: DataFrame, ts: str = "DepartureScheduled") -> DataFrame:
    """Rows per month with the peak / trough months and their ratio."""
    vol = df.groupBy(S.month_label(ts).alias("Month")).agg(F.count(F.lit(1)).alias("Flights"))
    peak = vol.agg(
        F.max_by("Month", F.struct(F.col("Flights"), -F.unix_date(F.to_date(F.concat("Month", F.lit("-01")))))).alias("PeakMonth"),
        F.max("Flights").alias("PeakFlights"),
        F.min_by("Month", F.struct(F.col("Flights"), F.unix_date(F.to_date(F.concat("Month", F.lit("-01")))))).alias("TroughMonth"),
        F.min("Flights").alias("TroughFlights"),
    )
    return with_scalars(vol, peak).withColumn(
        "PeakTroughRatio", F.col("PeakFlights") / F.col("TroughFlights")
    )


def error_by_group(df: DataFrame, by: str, value: str = "AbsError") -> DataFrame:
    """Mean and count of the absolute error, sample std of the signed
    residual, and a normal 95 % interval of the mean per group."""
    g = df.where(F.col(by).isNotNull()).groupBy(by).agg(
        F.avg(value).alias("MeanAbsError"),
        F.count(value).alias("Rows"),
        F.stddev_samp("Residual").alias("StdResid"),
        F.stddev_samp(value).alias("_std"),
    )
    half = F.lit(1.96) * F.col("_std") / F.sqrt(F.col("Rows"))
    return g.withColumns({"CILow": F.col("MeanAbsError") - half, "CIHigh": F.col("MeanAbsError") + half}).drop("_std")


def error_by_season(df: DataFrame, value: str = "AbsError") -> DataFrame:
    """Per season with the fixed Winter..Fall order as a column."""
    g = error_by_group(df, "Season", value)
    order = F.lit(None).cast("int")
    for i, s in enumerate(C.SEASON_ORDER):
        order = F.when(F.col("Season") == s, F.lit(i)).otherwise(order)
    return g.withColumn("SeasonOrder", order)


def residual_diagnostics(df: DataFrame) -> DataFrame:
    """The validation-diagnostics projection."""
    out = residuals(df.withColumn("y_pred_primary", F.col("PredictedBurn_kg")), "y_pred_primary")
    return out.select(
        "ScheduledRoute", "Carrier", "AOCDescription", "AircraftTypeGroup", "Origin", "Destination",
        "Season", "DepartureYear", "DepartureMonth", "DepartureHour", "Burnoff", "y_pred_primary",
        F.col("BaselinePred_kg").alias("Baseline_pred"), "Residual", "AbsError", "RelError",
        "ExcessBurn_kg", "ExcessBurnPct", "RouteDistanceKm", "LoadFactor", "TotalPassengers",
        "PlannedTripTime", "PlannedTOW", "PlannedZeroFuelWeight", "TeledyneRampWeight",
    )


def quantile_tails(df: DataFrame, x: str, y: str, lo: float = 0.2, hi: float = 0.8) -> DataFrame:
    """Mean of y over rows with x <= q_lo and x >= q_hi, and their gap."""
    q = exact_quantiles(df, x, {"_qlo": lo, "_qhi": hi})
    j = with_scalars(df, q)
    return j.agg(
        F.first("_qlo").alias("CutLow"),
        F.first("_qhi").alias("CutHigh"),
        F.avg(F.when(F.col(x) <= F.col("_qlo"), F.col(y))).alias("MeanLowTail"),
        F.avg(F.when(F.col(x) >= F.col("_qhi"), F.col(y))).alias("MeanHighTail"),
    ).withColumn("TailGap", F.col("MeanHighTail") - F.col("MeanLowTail"))


def trim_above_quantile(df: DataFrame, x: str, q: float = 0.99) -> DataFrame:
    """P10: rows with x <= the q-quantile of x."""
    cut = exact_quantiles(df, x, {"_cut": q})
    return with_scalars(df, cut).where(F.col(x) <= F.col("_cut")).drop("_cut")
