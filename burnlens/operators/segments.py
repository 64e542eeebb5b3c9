"""Segment engine: hierarchical z-scores (C8), multi-definition rollups
(A12/A13/A14), opportunity scoring (C11) and the route / segment / monitor /
scenario tables (C12-C16).

Shared-scan design. Each fact row is emitted once per segment definition as
``(SegmentType, SegmentName, keys..., measures)`` by a generator in the same
codegen stage as the scan (this is what ``GROUPING SETS`` expands to), then
one ``groupBy(SegmentType, SegmentName)`` aggregates with map-side partial
aggregation, so only per-segment partial sums cross the network and a hot
segment costs one partial row per task. Rows whose active key is NULL are
dropped, as pandas ``groupby`` does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions import scalar as S
from ..functions.quantile import exact_quantiles
from ..session import materialize
from .sizing import BROADCAST_BYTES, with_scalars

ALL_KEYS = [
    "ScheduledRoute", "AircraftTypeGroup", "Carrier", "Origin", "Destination",
    "Season", "DepartureHourBand", "LoadFactorBand", "DistanceBand",
]


def segment_long(df: DataFrame, specs: list, measures: list[str], keep_keys: bool = True) -> DataFrame:
    """Emit each row once per ``(label, key columns)`` spec."""
    used = [k for k in ALL_KEYS if any(k in cols for _, cols in specs)] if keep_keys else []
    structs = []
    for label, cols in specs:
        fields = [F.lit(label).alias("SegmentType"), S.segment_name(cols).alias("SegmentName")]
        for k in used:
            v = F.col(k).cast("string") if k in cols else F.lit(None).cast("string")
            fields.append(v.alias(k))
        structs.append(F.struct(*fields))
    return df.select(*measures, F.inline(F.array(*structs))).where(F.col("SegmentName").isNotNull())


# --------------------------------------------------------------------------
# Hierarchical segment z-scores


#: Bytes of a stats row beside its name.
STATS_ROW_BYTES = 32


def segment_stats(df: DataFrame, specs: list, value: str = "Residual_kg", min_size: int = C.MIN_SEGMENT_SIZE) -> DataFrame:
    """Per segment of every spec: size, mean, pop std (0 -> NULL); only
    segments with at least ``min_size`` rows."""
    long = segment_long(df, specs, [value], keep_keys=False)
    st = long.groupBy("SegmentType", "SegmentName").agg(
        F.count(F.lit(1)).alias("_count"),
        F.avg(value).alias("_mean"),
        F.stddev_pop(value).alias("_std"),
    )
    return st.where(F.col("_count") >= min_size).withColumn(
        "_std", F.when(F.col("_std") == 0, F.lit(None)).otherwise(F.col("_std"))
    )


def global_residual_stats(df: DataFrame, value: str = "Residual_kg") -> DataFrame:
    """1-row mean and pop std, std 0 -> 1.0."""
    return df.agg(F.avg(value).alias("_gmean"), F.stddev_pop(value).alias("_gstd_raw")).select(
        "_gmean", F.when(F.col("_gstd_raw") == 0, F.lit(1.0)).otherwise(F.col("_gstd_raw")).alias("_gstd")
    )


#: What ``segment_basis`` adds to a row.
BASIS_COLUMNS = ["_gmean", "_gstd", "ResidualMean_segment", "ResidualStd_segment", "SegmentBasis"]


def segment_basis(df: DataFrame, specs: list | None = None, value: str = "Residual_kg",
                  min_size: int = C.MIN_SEGMENT_SIZE, of: DataFrame | None = None) -> DataFrame:
    """C8, the part that needs other rows: mean and deviation of all rows (``_gmean``,
    ``_gstd``) and of the row's segment, and which segment that is; for the rows of ``of``
    (those of ``df`` by default), which need no more than the specs' key columns.

    The per-segment stats are one aggregate (shared scan), written once and
    joined back once per level. Each level is broadcast by its own size: a
    season or an aircraft type stays small whatever the number of routes.
    """
    specs = specs or C.Z_SPECS
    stats = materialize(segment_stats(df, specs, value, min_size), "segment-stats")
    size = F.sum(F.length("SegmentName") + STATS_ROW_BYTES).alias("size")
    sizes = {r.SegmentType: r.size for r in stats.groupBy("SegmentType").agg(size).collect()}  # a row per level
    out = with_scalars(df if of is None else of, global_residual_stats(df, value))
    for i, (label, cols) in enumerate(specs):
        lvl = stats.where(F.col("SegmentType") == label).select(
            F.col("SegmentName").alias(f"_n{i}"),
            F.col("_mean").alias(f"_m{i}"),
            F.col("_std").alias(f"_s{i}"),
            F.lit(True).alias(f"_hit{i}"),
        )
        if sizes.get(label, 0) <= BROADCAST_BYTES:
            lvl = F.broadcast(lvl)
        out = out.join(lvl, S.segment_name(cols) == F.col(f"_n{i}"), "left").drop(f"_n{i}")
    basis = F.lit("Global")
    mean = F.col("_gmean")
    std = F.col("_gstd")
    for i, (label, _) in reversed(list(enumerate(specs))):
        hit = F.col(f"_hit{i}").isNotNull()
        basis = F.when(hit, F.lit(label)).otherwise(basis)
        mean = F.when(hit, F.col(f"_m{i}")).otherwise(mean)
        std = F.when(hit, F.coalesce(F.col(f"_s{i}"), F.col("_gstd"))).otherwise(std)
    out = out.withColumns({"ResidualMean_segment": mean, "ResidualStd_segment": std, "SegmentBasis": basis})
    return out.drop(*[f"_{p}{i}" for i in range(len(specs)) for p in ("m", "s", "hit")])


def zscores_of_basis(df: DataFrame, value: str = "Residual_kg") -> DataFrame:
    """C8, the part within a row: both z-scores from the columns of ``segment_basis``."""
    seg_std = F.coalesce(
        F.when(F.col("ResidualStd_segment") == 0, F.col("_gstd")).otherwise(F.col("ResidualStd_segment")),
        F.col("_gstd"),
    )
    return df.withColumns(
        {
            "ResidualZ_global": (F.col(value) - F.col("_gmean")) / F.col("_gstd"),
            "ResidualZ_segment": (F.col(value) - F.col("ResidualMean_segment")) / seg_std,
        }
    ).drop("_gmean", "_gstd")


def segment_zscores(df: DataFrame, specs: list | None = None, value: str = "Residual_kg",
                    min_size: int = C.MIN_SEGMENT_SIZE) -> DataFrame:
    """The first spec (in order) whose segment has >= ``min_size`` rows
    supplies mean and std (std NULL -> global std); otherwise the global
    mean / std. Adds ResidualMean_segment, ResidualStd_segment,
    SegmentBasis, ResidualZ_global, ResidualZ_segment."""
    return zscores_of_basis(segment_basis(df, specs, value, min_size), value)


# --------------------------------------------------------------------------
# C11: opportunity score


def opportunity_score(frame: DataFrame, cost: str, rate: str, volume: str, std: str,
                      by: list[str] | None = None) -> DataFrame:
    """Adds ``OpportunityScore`` = cost * rate * max(log1p(volume), 1) *
    (0.5 + 0.5 * stability), stability = clip(1 - std / (median std + 1e-9), 0, 1)
    with NULL -> 0; the median is taken over ``frame`` (per ``by`` group)."""
    by = list(by or [])
    # one row per segment: written once, so neither the median nor the score
    # recomputes the rollup, and its long projection stays a stage of its own
    frame = materialize(frame, "segments")
    med = exact_quantiles(frame, std, {"_std_median": 0.5}, by=by)
    if by:
        med = med.select(*[F.col(c).alias(f"_j_{c}") for c in by], "_std_median")
        cond = [F.col(c).eqNullSafe(F.col(f"_j_{c}")) for c in by]
        out = frame.join(med, cond, "left").drop(*[f"_j_{c}" for c in by])
    else:
        out = with_scalars(frame, med)
    den = F.col("_std_median") + F.lit(C.STABILITY_EPS)
    ratio = F.when(den == 0, F.lit(1.0)).otherwise(F.col(std) / den)
    stability = S.clip(F.coalesce(F.lit(1.0) - ratio, F.lit(0.0)), 0.0, 1.0)
    vol = F.log1p(S.clip(volume, lo=0.0))
    score = (
        F.coalesce(F.col(cost), F.lit(0.0))
        * F.coalesce(F.col(rate), F.lit(0.0))
        * F.greatest(F.coalesce(vol, F.lit(1.0)), F.lit(1.0))
        * (F.lit(0.5) + F.lit(0.5) * stability)
    )
    return out.withColumn("OpportunityScore", score).drop("_std_median")


def _confidence(n: Column) -> Column:
    return S.clip(n / F.lit(C.CONFIDENCE_FLIGHTS), 0.0, 1.0)


def _persistent(n: str = "FlightCount", rate: str = "PositiveExcessRate", mean: str = "MeanExcessBurn") -> Column:
    return (
        (F.col(n) >= C.MIN_SEGMENT_SIZE)
        & S.is_true(F.col(rate) >= C.PERSISTENT_RATE)
        & S.is_true(F.col(mean) > 0)
    )


def _rate(cond: Column) -> Column:
    """``(cond).mean()`` over all rows: NULL counts as False."""
    return F.avg(S.is_true(cond).cast("double"))


def _total0(c: str) -> Column:
    """pandas ``sum`` (empty / all-missing -> 0), exact."""
    return F.coalesce(S.fixed_sum(c), F.lit(0.0))


def mode_of_counts(value: str, count: str) -> Column:
    """Aggregate over one row per distinct value and its count: the most frequent
    non-NULL value, the smallest on ties. Merged across tasks, without a window."""
    return F.min(F.when(F.col(value).isNotNull(), F.struct((-F.col(count)).alias("c"), F.col(value).alias("v"))))["v"]


def group_mode(df: DataFrame, by: list[str], value: str, name: str) -> DataFrame:
    """Most frequent non-NULL ``value`` per group, smallest on ties, from counts
    per (group, value)."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("_c"))
    return counts.groupBy(*by).agg(mode_of_counts(value, "_c").alias(name))


# --------------------------------------------------------------------------
# Route opportunity


def route_geography(df: DataFrame, airports: DataFrame, route: str = "ScheduledRoute") -> DataFrame:
    """Distinct routes with known origin coordinates and both ends' location
    (the geography part of the route-error table, J7)."""
    from ..sources.airports import with_location

    r = df.where(F.col(route).isNotNull()).select(route).distinct()
    r = r.withColumns({"Origin": S.route_part(route, 0), "Destination": S.route_part(route, 1)})
    r = with_location(r, airports, "Origin", "Org").drop("OrgCountry")
    r = with_location(r, airports, "Destination", "Dst").drop("DstCountry")
    return r.where(F.col("OrgLat").isNotNull() & F.col("OrgLon").isNotNull()).select(
        route, "Origin", "Destination", "OrgLat", "OrgLon", "DstLat", "DstLon", "OrgCity", "DstCity"
    )


ROUTE_MEANS = {
    "ActualBurn_kg": "MeanActualBurn", "PredictedBurn_kg": "MeanPredictedBurn", "ExcessBurn_kg": "MeanExcessBurn",
    "AvoidableFuelCost_eur": "MeanAvoidableCost_eur", "StructuralCO2_kg": "MeanStructuralCO2_kg",
    "AvoidableCO2_kg": "MeanAvoidableCO2_kg", "OpsPlanningGap_kg": "MeanOpsPlanningGap_kg",
    "LoadFactor": "MeanLoadFactor", "RouteDistanceKm": "MeanDistanceKm",
}
ROUTE_RATES = {"PositiveExcessRate": "ExcessBurn_kg > 0", "AnomalyRate": "IsAnomaly", "OverburnAnomalyRate": "IsOverburnAnomaly"}
ROUTE_TOTALS = {"AvoidableCO2_kg": "TotalAvoidableCO2_kg", "AvoidableFuelCost_eur": "TotalAvoidableCost_eur"}


def route_opportunity(flights: DataFrame, airports: DataFrame | None = None,
                      econ: C.Economics = C.Economics()) -> DataFrame:
    """Per-route rollup, annualised, scored and flagged."""
    f = flights.where(F.col("ScheduledRoute").isNotNull())
    # One pass by (route, type): the mode and every total follow from its rows.
    parts = f.groupBy("ScheduledRoute", "AircraftTypeGroup").agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.sum(c).alias(f"_sum_{c}") for c in ROUTE_MEANS],
        *[F.count(c).alias(f"_has_{c}") for c in ROUTE_MEANS],
        *[F.count_if(F.expr(cond)).alias(f"_is_{name}") for name, cond in ROUTE_RATES.items()],
        *[F.sum(S.fixed_units(c)).alias(f"_total_{c}") for c in ROUTE_TOTALS],
        F.sum(F.col("ExcessBurn_kg") * F.col("ExcessBurn_kg")).alias("_squares"),
        F.count("Residual_kg").alias("_r_n"), F.avg("Residual_kg").alias("_r_mean"), F.var_pop("Residual_kg").alias("_r_var"),
    )

    def mean(c: str) -> Column:
        return F.sum(f"_sum_{c}") / F.nullif(F.sum(f"_has_{c}"), F.lit(0))

    # the spread of a route: within its types, and of their means around its own
    around = F.sum(F.col("_r_n") * F.col("_r_mean")) / F.nullif(F.sum("_r_n"), F.lit(0))
    between = F.sum(F.col("_r_n") * F.col("_r_mean") * F.col("_r_mean")) / F.nullif(F.sum("_r_n"), F.lit(0)) - around * around
    within = F.sum(F.col("_r_n") * F.col("_r_var")) / F.nullif(F.sum("_r_n"), F.lit(0))
    agg = parts.groupBy("ScheduledRoute").agg(
        F.sum("_n").alias("FlightCount"),
        *[mean(c).alias(name) for c, name in ROUTE_MEANS.items()],
        *[(F.sum(f"_is_{name}") / F.sum("_n")).alias(name) for name in ROUTE_RATES],
        *[F.coalesce(S.from_units(F.sum(f"_total_{c}")), F.lit(0.0)).alias(name) for c, name in ROUTE_TOTALS.items()],
        F.sqrt(within + F.greatest(between, F.lit(0.0))).alias("ResidualStd"),
        F.sqrt(F.sum("_squares") / F.nullif(F.sum("_has_ExcessBurn_kg"), F.lit(0))).alias("RouteRMSE"),
        F.coalesce(mode_of_counts("AircraftTypeGroup", "_n"), F.lit(C.UNKNOWN)).alias("AircraftTypeMode"),
    )
    q = exact_quantiles(f, "ExcessBurn_kg", {"MedianExcessBurn": 0.5, "P90ExcessBurn": 0.9}, by=["ScheduledRoute"], write=True)
    out = agg.join(q, "ScheduledRoute", "left")
    out = with_scalars(out, flights.agg((F.lit(float(econ.annual_flights)) / F.count(F.lit(1))).alias("_scale")))
    out = out.withColumns(
        {
            "AnnualAvoidableCO2_t": F.col("TotalAvoidableCO2_kg") * F.col("_scale") / 1000,
            "AnnualAvoidableCost_eur": F.col("TotalAvoidableCost_eur") * F.col("_scale"),
            "StructuralVsAvoidableRatio": S.safe_div("MeanAvoidableCO2_kg", "MeanStructuralCO2_kg"),
            "ConfidenceScore": _confidence(F.col("FlightCount")),
        }
    ).drop("_scale")
    out = opportunity_score(out, "AnnualAvoidableCost_eur", "PositiveExcessRate", "FlightCount", "ResidualStd")
    out = out.withColumns(
        {
            "VolumePriority": F.col("FlightCount") * S.positive_part("MeanExcessBurn"),
            "PersistentOverburnFlag": _persistent(),
        }
    )
    if airports is not None:
        # the routes of the written rollup, not another pass over the flights
        out = out.join(route_geography(out, airports), "ScheduledRoute", "left")
    return out


def co2_hotspots(route_opp: DataFrame) -> DataFrame:
    """The sustainability projection of the route table."""
    return route_opp.select(
        "ScheduledRoute", "FlightCount", "MeanDistanceKm", "MeanLoadFactor", "MeanStructuralCO2_kg",
        "MeanAvoidableCO2_kg", "AnnualAvoidableCO2_t", "StructuralVsAvoidableRatio", "OpportunityScore",
    )


# --------------------------------------------------------------------------
# C14: segment opportunity (11 definitions, one scan)

SEGMENT_MEASURES = [
    "ActualBurn_kg", "ExcessBurn_kg", "IsAnomaly", "IsOverburnAnomaly", "AvoidableFuelCost_eur",
    "AvoidableCO2_kg", "Residual_kg", "StructuralCO2_kg", "OpsPlanningGap_kg",
]


def segment_opportunity(flights: DataFrame, specs: list | None = None, econ: C.Economics = C.Economics()) -> DataFrame:
    specs = specs or C.SEGMENT_SPECS
    long = segment_long(flights, specs, SEGMENT_MEASURES)
    keys = [c for c in long.columns if c in ALL_KEYS]
    gk = ["SegmentType", "SegmentName"]
    # the key columns are functions of SegmentName: grouping by them too keeps
    # the groups and keeps the aggregate on the hash (not sort) path
    agg = long.groupBy(*gk, *keys).agg(
        F.count(F.lit(1)).alias("FlightCount"),
        F.avg("ExcessBurn_kg").alias("MeanExcessBurn"),
        _rate(F.col("ExcessBurn_kg") > 0).alias("PositiveExcessRate"),
        _rate(F.col("IsAnomaly")).alias("AnomalyRate"),
        _rate(F.col("IsOverburnAnomaly")).alias("OverburnAnomalyRate"),
        F.avg("AvoidableFuelCost_eur").alias("MeanAvoidableCost_eur"),
        _total0("AvoidableFuelCost_eur").alias("TotalAvoidableCost_eur"),
        _total0("AvoidableCO2_kg").alias("TotalAvoidableCO2_kg"),
        F.stddev_pop("Residual_kg").alias("ResidualStd"),
        F.avg("StructuralCO2_kg").alias("MeanStructuralCO2_kg"),
        F.avg("OpsPlanningGap_kg").alias("MeanOpsPlanningGap_kg"),
    )
    # narrow copy of the expansion for the quantile passes: no key columns
    narrow = segment_long(flights, specs, ["ExcessBurn_kg"], keep_keys=False)
    med = exact_quantiles(narrow, "ExcessBurn_kg", {"MedianExcessBurn": 0.5}, by=gk, write=True)
    out = agg.join(med, gk, "left")
    out = with_scalars(out, flights.agg((F.lit(float(econ.annual_flights)) / F.count(F.lit(1))).alias("_scale")))
    out = out.withColumns(
        {
            "AnnualAvoidableCost_eur": F.col("TotalAvoidableCost_eur") * F.col("_scale"),
            "AnnualAvoidableCO2_t": F.col("TotalAvoidableCO2_kg") * F.col("_scale") / 1000,
            "ConfidenceScore": _confidence(F.col("FlightCount")),
        }
    ).drop("_scale")
    out = opportunity_score(
        out, "AnnualAvoidableCost_eur", "PositiveExcessRate", "FlightCount", "ResidualStd", by=["SegmentType"]
    )
    return out.withColumn("PersistentOverburnFlag", _persistent())


# --------------------------------------------------------------------------
# Persistent anomaly monitor (5 definitions, one scan)


def anomaly_monitor(flights: DataFrame, specs: list | None = None) -> DataFrame:
    specs = specs or C.MONITOR_SPECS
    long = segment_long(
        flights, specs,
        ["IsAnomaly", "IsOverburnAnomaly", "IsUnderburnAnomaly", "ExcessBurn_kg", "Residual_kg", "OpsPlanningGap_kg"],
    )
    keys = [c for c in long.columns if c in ALL_KEYS]
    mon = long.groupBy("SegmentType", "SegmentName", *keys).agg(
        F.count(F.lit(1)).alias("FlightCount"),
        F.count_if("IsAnomaly").alias("AnomalyCount"),
        F.count_if("IsOverburnAnomaly").alias("OverburnCount"),
        F.count_if("IsUnderburnAnomaly").alias("UnderburnCount"),
        _rate(F.col("IsAnomaly")).alias("AnomalyRate"),
        F.avg("ExcessBurn_kg").alias("MeanExcessBurn"),
        F.stddev_pop("Residual_kg").alias("ResidualStd"),
        F.avg("OpsPlanningGap_kg").alias("MeanOpsPlanningGap_kg"),
    )
    return mon.withColumns(
        {
            "PersistenceFlag": (F.col("FlightCount") >= C.MIN_SEGMENT_SIZE)
            & S.is_true(F.col("AnomalyRate") >= C.MONITOR_PERSISTENT_RATE),
            "LikelyIssueClass": F.when(
                S.is_true(F.col("MeanOpsPlanningGap_kg") > C.PLANNING_GAP_KG),
                "Planning bias / conservative fuel loading",
            )
            .when(S.is_true(F.col("MeanExcessBurn") > 0), "Recurring operational over-burn")
            .otherwise("Mixed / low-signal"),
        }
    )


def persistence_by_type(monitor: DataFrame, min_flights: int = 5) -> DataFrame:
    """Per segment type: % persistent, mean anomaly rate, segments."""
    return monitor.where(F.col("FlightCount") >= min_flights).groupBy("SegmentType").agg(
        (F.avg(F.col("PersistenceFlag").cast("double")) * 100).alias("PersistentPct"),
        (F.avg("AnomalyRate") * 100).alias("MeanAnomalyRatePct"),
        F.count(F.lit(1)).alias("Segments"),
    )


# --------------------------------------------------------------------------
# Intervention scenarios


def intervention_scenarios(segment_opp: DataFrame, types: list[str] | None = None) -> DataFrame:
    """Each qualifying segment row emitted once per scenario by a generator
    (no join): two fixed-share reductions and the peer-median move."""
    types = types or C.SCENARIO_SEGMENT_TYPES
    base = segment_opp.where(F.col("SegmentType").isin(*types)).withColumn(
        "CurrentAnnualValue_eur", F.col("AnnualAvoidableCost_eur")
    )
    peer = S.clip(F.col("PositiveExcessRate") - 0.5, 0.0, 1.0)
    choices = [F.struct(F.lit(name).alias("Scenario"), F.lit(f).cast("double").alias("_f")) for name, f in C.SCENARIOS]
    choices.append(F.struct(F.lit(C.PEER_SCENARIO).alias("Scenario"), peer.cast("double").alias("_f")))
    out = base.select("*", F.inline(F.array(*choices)))
    return out.withColumns(
        {
            "SavingsPotential_eur": F.col("CurrentAnnualValue_eur") * F.col("_f"),
            "SavingsPotential_CO2_t": F.col("AnnualAvoidableCO2_t") * F.col("_f"),
        }
    ).drop("_f")
