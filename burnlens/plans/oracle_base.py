"""DuckDB text of the shared stages, used by every oracle query.

The CTE chain mirrors ``sources.bind`` -> ``operators.features`` ->
``operators.predict`` -> stage-6 flight layer expression by expression, so
each oracle query is ``BASE + <its own body>``.
"""

from __future__ import annotations

from .. import config as C


def sr(expr: str, digits: int = 9) -> str:
    """SQL twin of ``functions.scalar.sig_round``."""
    k = f"(floor(log10(abs({expr}))) - {digits - 1})"
    return (
        f"(CASE WHEN ({expr}) IS NULL OR ({expr}) = 0 OR isnan({expr}) OR isinf({expr}) THEN ({expr}) "
        f"WHEN {k} >= 0 THEN floor(({expr}) / pow(10.0, {k}) + 0.5137) * pow(10.0, {k}) "
        f"ELSE floor(({expr}) * pow(10.0, -{k}) + 0.5137) / pow(10.0, -{k}) END)"
    )


def fsum(expr: str) -> str:
    """SQL twin of ``functions.scalar.fixed_sum``."""
    unit = f"CAST({10 ** C.FIXED_PLACES} AS DOUBLE)"
    return f"(CAST(sum(CAST(floor(({expr}) * {unit} + 0.5) AS BIGINT)) AS DOUBLE) / {unit})"


def wrap(body: str, cols: str) -> str:
    """Outer projection: ``cols`` is a comma list; a ``:d`` suffix marks a
    DOUBLE output that depends on the order of the rows and gets the
    significant-digit rounding."""
    items = []
    for c in [x.strip() for x in cols.split(",") if x.strip()]:
        if c.endswith(":d"):
            name = c[:-2]
            items.append(f'{sr(chr(34) + name + chr(34))} AS "{name}"')
        else:
            items.append(f'"{c}"')
    return f"SELECT {', '.join(items)} FROM (\n{body}\n) AS _q"


def _case_hour_band(h: str) -> str:
    parts = [f"WHEN {h} IS NULL THEN '{C.UNKNOWN}'"]
    for name, lo, hi in C.HOUR_BANDS:
        parts.append(f"WHEN {h} BETWEEN {lo} AND {hi} THEN '{name}'")
    return f"CASE {' '.join(parts)} ELSE '{C.NIGHT_BAND}' END"


def _case_lt(x: str, bands, top: str) -> str:
    parts = [f"WHEN {x} IS NULL OR isnan({x}) THEN '{C.UNKNOWN}'"]
    for name, upper in bands:
        parts.append(f"WHEN {x} < {upper} THEN '{name}'")
    return f"CASE {' '.join(parts)} ELSE '{top}' END"


def _season(m: str) -> str:
    parts = []
    for name, months in C.SEASONS.items():
        if name == "Fall":
            continue
        parts.append(f"WHEN {m} IN ({', '.join(str(x) for x in months)}) THEN '{name}'")
    return f"CASE {' '.join(parts)} ELSE 'Fall' END"


def _type_factor(t: str) -> str:
    parts = [f"WHEN {t} = '{k}' THEN CAST({v} AS DOUBLE)" for k, v in C.TYPE_FACTORS.items()]
    return f"CASE {' '.join(parts)} ELSE CAST(1.0 AS DOUBLE) END"


def _pos(x: str) -> str:
    return f"(CASE WHEN {x} IS NULL THEN NULL ELSE greatest({x}, CAST(0.0 AS DOUBLE)) END)"


def _safe_div(n: str, d: str) -> str:
    return f"(CASE WHEN {d} = 0 THEN NULL ELSE ({n}) / ({d}) END)"


def _seg_name(cols: list[str], alias: str = "") -> str:
    p = f"{alias}." if alias else ""
    if len(cols) == 1:
        return f"CAST({p}{cols[0]} AS VARCHAR)"
    return f" || '{C.SEGMENT_SEP}' || ".join(f"CAST({p}{c} AS VARCHAR)" for c in cols)


HAV = (
    "CAST(12742.0 AS DOUBLE) * asin(sqrt(pow(sin(radians(d.lat - o.lat) / 2), 2) + "
    "cos(radians(o.lat)) * cos(radians(d.lat)) * pow(sin(radians(d.lon - o.lon) / 2), 2)))"
)


def _zstats_sql() -> str:
    parts = []
    for label, cols in C.Z_SPECS:
        name = _seg_name(cols)
        nn = " AND ".join(f"{c} IS NOT NULL" for c in cols)
        parts.append(
            f"SELECT '{label}' AS SegmentType, {name} AS SegmentName, count(*) AS _count, "
            f"avg(Residual_kg) AS _mean, stddev_pop(Residual_kg) AS _std FROM f0 WHERE {nn} GROUP BY 1, 2"
        )
    return "\nUNION ALL\n".join(parts)


def _zjoin_sql() -> str:
    joins, sel_hit = [], []
    for i, (label, cols) in enumerate(C.Z_SPECS):
        joins.append(
            f"LEFT JOIN zst z{i} ON z{i}.SegmentType = '{label}' AND z{i}.SegmentName = {_seg_name(cols, 'f0')}"
        )
        sel_hit.append(f"z{i}._mean AS _m{i}, z{i}._std AS _s{i}, z{i}.SegmentName IS NOT NULL AS _hit{i}")
    return ", ".join(sel_hit), "\n".join(joins)


def _zpick_sql() -> str:
    mean, std, basis = [], [], []
    for i, (label, _) in enumerate(C.Z_SPECS):
        mean.append(f"WHEN _hit{i} THEN _m{i}")
        std.append(f"WHEN _hit{i} THEN coalesce(_s{i}, _gstd)")
        basis.append(f"WHEN _hit{i} THEN '{label}'")
    return (
        f"CASE {' '.join(mean)} ELSE _gmean END AS ResidualMean_segment, "
        f"CASE {' '.join(std)} ELSE _gstd END AS ResidualStd_segment, "
        f"CASE {' '.join(basis)} ELSE 'Global' END AS SegmentBasis"
    )


_zsel, _zjoins = _zjoin_sql()
_zdrop = ", ".join(f"_m{i}, _s{i}, _hit{i}" for i in range(len(C.Z_SPECS)))

BASE = f"""
WITH airports AS (
  SELECT upper(n.n_name) AS iata,
         CASE WHEN n.n_nationkey < 24 THEN CAST(-60.0 AS DOUBLE) + CAST(5.0 AS DOUBLE) * n.n_nationkey END AS lat,
         CASE WHEN n.n_nationkey < 24 THEN CAST(-170.0 AS DOUBLE) + CAST(13.7 AS DOUBLE) * n.n_nationkey END AS lon,
         n.n_name AS city, r.r_name AS country
  FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
),
raw AS (
  SELECT concat_ws('-', l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, CAST(round(l.l_extendedprice * 100) AS BIGINT), strftime(l.l_shipdate, '%Y-%m-%d')) AS RowKey,
         l.l_orderkey AS OrderKey,
         sn.n_name || '-' || cn.n_name AS ScheduledRoute,
         l.l_shipdate + to_hours(CAST(l.l_partkey % 24 AS INTEGER)) AS DepartureScheduled,
         CASE {' '.join(f"WHEN p.p_type = '{k}' THEN '{v}'" for k, v in C.TYPE_NAMES.items())} ELSE p.p_type END AS AircraftTypeGroup,
         c.c_mktsegment AS Carrier,
         l.l_returnflag AS AOCDescription,
         CAST(p.p_size + 10 AS INTEGER) AS AircraftCapacity,
         CAST(l.l_quantity AS INTEGER) AS Adults,
         l.l_linenumber AS Children,
         0 AS Infants,
         CASE WHEN l.l_discount <> 0 THEN l.l_discount END AS Freight,
         CAST(60 + l.l_partkey % 180 AS DOUBLE) AS BlockTimeScheduled,
         (CAST(60 + l.l_partkey % 180 AS DOUBLE) - 20) * 60 AS PlannedTripTime,
         CAST(40000.0 AS DOUBLE) + p.p_retailprice * l.l_quantity / 10 AS PlannedTOW,
         CAST(40000.0 AS DOUBLE) + p.p_retailprice * l.l_quantity / 10 - 3000 - l.l_quantity * 100 AS PlannedZeroFuelWeight,
         CAST(40000.0 AS DOUBLE) + p.p_retailprice * l.l_quantity / 10 + l.l_tax * 10000 AS TeledyneRampWeight,
         (l.l_extendedprice - 1000) / 10 AS Burnoff
  FROM lineitem l
  JOIN part p ON l.l_partkey = p.p_partkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation sn ON s.s_nationkey = sn.n_nationkey
  JOIN nation cn ON c.c_nationkey = cn.n_nationkey
),
eng0 AS (
  SELECT r.*,
         CAST(hour(DepartureScheduled) AS INTEGER) AS DepartureHour,
         CAST(month(DepartureScheduled) AS INTEGER) AS DepartureMonth,
         CAST(year(DepartureScheduled) AS INTEGER) AS DepartureYear,
         CAST(isodow(DepartureScheduled) - 1 AS INTEGER) AS DepartureDayOfWeek,
         string_split(ScheduledRoute, '-')[1] AS Origin,
         string_split(ScheduledRoute, '-')[2] AS Destination,
         CASE WHEN len(string_split(ScheduledRoute, '-')) = 2 THEN upper(string_split(ScheduledRoute, '-')[1]) END AS _oc,
         CASE WHEN len(string_split(ScheduledRoute, '-')) = 2 THEN upper(string_split(ScheduledRoute, '-')[2]) END AS _dc,
         Adults + Children + Infants AS TotalPassengers
  FROM raw r
  WHERE Burnoff > 0
),
eng AS (
  SELECT e.* EXCLUDE (_oc, _dc),
         {_season('e.DepartureMonth')} AS Season,
         ({HAV}) IS NULL AS DistanceImputed,
         coalesce({HAV}, e.BlockTimeScheduled / 60 * CAST(750.0 AS DOUBLE)) AS RouteDistanceKm,
         CASE WHEN e.AircraftCapacity = 0 THEN (CASE WHEN e.TotalPassengers > 0 THEN CAST(1.0 AS DOUBLE)
                                                     WHEN e.TotalPassengers < 0 THEN CAST(0.0 AS DOUBLE) END)
              ELSE least(greatest(CAST(e.TotalPassengers AS DOUBLE) / e.AircraftCapacity, CAST(0.0 AS DOUBLE)), CAST(1.0 AS DOUBLE)) END AS LoadFactor,
         coalesce(e.Freight, CAST(0.0 AS DOUBLE)) AS FreightPerKg,
         e.PlannedTOW - e.PlannedZeroFuelWeight AS WeightDelta,
         {_type_factor('e.AircraftTypeGroup')} * e.PlannedTOW AS TypeWeightInteraction,
         {_type_factor('e.AircraftTypeGroup')} * e.PlannedTripTime AS TypeTripTimeInteraction,
         e.TeledyneRampWeight - e.PlannedTOW AS BaselineDelta,
         e.Burnoff / (CASE WHEN e.PlannedTripTime / 60 IS NULL THEN NULL
                           ELSE greatest(e.PlannedTripTime / 60, CAST(0.1 AS DOUBLE)) END) AS BurnoffPerMinute
  FROM eng0 e
  LEFT JOIN airports o ON e._oc = o.iata
  LEFT JOIN airports d ON e._dc = d.iata
),
splitf AS (
  SELECT eng.*,
         CAST((('0x' || substr(md5(CAST(OrderKey AS VARCHAR)), 1, 8))::BIGINT % 100) AS INTEGER) < {C.SPLIT_VALIDATION_PCT} AS IsValidation,
         CAST((('0x' || substr(md5(CAST(OrderKey AS VARCHAR)), 1, 8))::BIGINT % 100) % {C.N_FOLDS} AS INTEGER) AS Fold
  FROM eng
),
gm_model AS (
  SELECT AircraftTypeGroup, CAST(sum(CAST(Burnoff AS DECIMAL(38,6))) AS DOUBLE) / count(Burnoff) AS PredictedBurn_kg FROM splitf
  WHERE NOT IsValidation AND AircraftTypeGroup IS NOT NULL GROUP BY 1
),
gm_base AS (
  SELECT AircraftTypeGroup, CAST(sum(CAST(Burnoff AS DECIMAL(38,6))) AS DOUBLE) / count(Burnoff) AS BaselinePred_kg FROM splitf
  WHERE AircraftTypeGroup IS NOT NULL GROUP BY 1
),
bench AS (
  SELECT s.*, m.PredictedBurn_kg, b.BaselinePred_kg
  FROM splitf s
  LEFT JOIN gm_model m ON s.AircraftTypeGroup = m.AircraftTypeGroup
  LEFT JOIN gm_base b ON s.AircraftTypeGroup = b.AircraftTypeGroup
),
resid AS (
  SELECT bench.*,
         PredictedBurn_kg - Burnoff AS Residual,
         abs(PredictedBurn_kg - Burnoff) AS AbsError,
         abs(PredictedBurn_kg - Burnoff) / (CASE WHEN Burnoff IS NULL THEN NULL ELSE greatest(Burnoff, CAST(1.0 AS DOUBLE)) END) AS RelError,
         -(PredictedBurn_kg - Burnoff) AS Excess,
         -(PredictedBurn_kg - Burnoff) / (CASE WHEN PredictedBurn_kg IS NULL THEN NULL ELSE greatest(PredictedBurn_kg, CAST(1.0 AS DOUBLE)) END) * 100 AS ExcessBurnPct
  FROM bench
),
f00 AS (
  SELECT bench.*,
         Burnoff AS ActualBurn_kg,
         PredictedBurn_kg - Burnoff AS Residual_kg,
         abs(PredictedBurn_kg - Burnoff) AS AbsError_kg,
         -(PredictedBurn_kg - Burnoff) AS ExcessBurn_kg,
         TeledyneRampWeight - PlannedZeroFuelWeight AS PlannedFuelProxy_kg,
         TeledyneRampWeight - PlannedZeroFuelWeight - PredictedBurn_kg AS OpsPlanningGap_kg
  FROM bench
),
f0 AS (
  SELECT f00.*,
         {_safe_div('ExcessBurn_kg', 'PredictedBurn_kg')} * 100 AS ExcessBurnPct_pred,
         {_safe_div('ExcessBurn_kg', 'ActualBurn_kg')} * 100 AS ExcessBurnPct_actual,
         {_safe_div('ActualBurn_kg', 'RouteDistanceKm')} AS ActualBurnPerKm,
         {_safe_div('PredictedBurn_kg', 'RouteDistanceKm')} AS PredictedBurnPerKm,
         {_safe_div('ActualBurn_kg', 'RouteDistanceKm')} - {_safe_div('PredictedBurn_kg', 'RouteDistanceKm')} AS IntensityGapPerKm,
         CASE WHEN coalesce(TotalPassengers > 0 AND TotalPassengers * RouteDistanceKm > 0, false)
              THEN {_safe_div('ActualBurn_kg * 1000', 'TotalPassengers * RouteDistanceKm')} END AS BurnPerPaxKm_actual,
         CASE WHEN coalesce(TotalPassengers > 0 AND TotalPassengers * RouteDistanceKm > 0, false)
              THEN {_safe_div('PredictedBurn_kg * 1000', 'TotalPassengers * RouteDistanceKm')} END AS BurnPerPaxKm_pred,
         PredictedBurn_kg * CAST({C.CO2_PER_KG_FUEL} AS DOUBLE) AS StructuralCO2_kg,
         ActualBurn_kg * CAST({C.CO2_PER_KG_FUEL} AS DOUBLE) AS ActualCO2_kg,
         {_pos('ExcessBurn_kg')} * CAST({C.CO2_PER_KG_FUEL} AS DOUBLE) AS AvoidableCO2_kg,
         {_pos('ExcessBurn_kg')} * CAST({C.FUEL_PRICE_PER_KG} AS DOUBLE) AS AvoidableFuelCost_eur,
         {_pos('OpsPlanningGap_kg')} * CAST({C.FUEL_CARRY_PENALTY} AS DOUBLE) * CAST({C.FUEL_PRICE_PER_KG} AS DOUBLE) AS CarryPenaltyCost_eur,
         {_case_hour_band('DepartureHour')} AS DepartureHourBand,
         {_case_lt('LoadFactor', C.LOAD_BANDS, C.LOAD_BAND_TOP)} AS LoadFactorBand,
         {_case_lt('RouteDistanceKm', C.DISTANCE_BANDS, C.DISTANCE_BAND_TOP)} AS DistanceBand
  FROM f00
),
zst AS (
  SELECT SegmentType, SegmentName, _count, _mean, CASE WHEN _std = 0 THEN NULL ELSE _std END AS _std
  FROM (
{_zstats_sql()}
  ) WHERE _count >= {C.MIN_SEGMENT_SIZE}
),
gst AS (
  SELECT avg(Residual_kg) AS _gmean,
         CASE WHEN stddev_pop(Residual_kg) = 0 THEN CAST(1.0 AS DOUBLE) ELSE stddev_pop(Residual_kg) END AS _gstd
  FROM f0
),
f1 AS (
  SELECT f0.*, gst._gmean, gst._gstd, {_zsel}
  FROM f0 CROSS JOIN gst
  {_zjoins}
),
f2 AS (
  SELECT f1.* EXCLUDE ({_zdrop}), {_zpick_sql()} FROM f1
),
f3 AS (
  SELECT f2.* EXCLUDE (_gmean, _gstd),
         (Residual_kg - _gmean) / _gstd AS ResidualZ_global,
         (Residual_kg - ResidualMean_segment) / coalesce(CASE WHEN ResidualStd_segment = 0 THEN _gstd ELSE ResidualStd_segment END, _gstd) AS ResidualZ_segment
  FROM f2
),
qcut AS (SELECT quantile_cont(AbsError_kg, {C.DATA_ISSUE_QUANTILE}) AS _abs_cut FROM f3),
f4 AS (
  SELECT f3.*,
         coalesce(ResidualZ_segment < -{C.ANOMALY_Z}, false) AS IsOverburnAnomaly,
         coalesce(ResidualZ_segment > {C.ANOMALY_Z}, false) AS IsUnderburnAnomaly,
         coalesce(AbsError_kg > qcut._abs_cut, false) OR coalesce(ActualBurn_kg < {C.DATA_ISSUE_MIN_BURN}, false)
           OR coalesce(RouteDistanceKm < {C.DATA_ISSUE_MIN_KM}, false) AS PossibleDataIssue
  FROM f3 CROSS JOIN qcut
),
flights AS (
  SELECT f4.*,
         IsOverburnAnomaly OR IsUnderburnAnomaly AS IsAnomaly,
         CASE WHEN IsOverburnAnomaly THEN 'Over-consumption' WHEN IsUnderburnAnomaly THEN 'Under-consumption' ELSE 'Normal' END AS AnomalyType,
         CASE WHEN PossibleDataIssue THEN 'Possible data-quality issue'
              WHEN coalesce(OpsPlanningGap_kg > {C.PLANNING_GAP_KG}, false) THEN 'Planning conservatism / fuel policy'
              WHEN IsOverburnAnomaly THEN 'Operational over-burn'
              WHEN IsUnderburnAnomaly THEN 'Favourable conditions / under-burn'
              ELSE 'Normal' END AS LikelyIssueClass,
         AvoidableCO2_kg * (CAST({float(C.ANNUAL_FLIGHTS)} AS DOUBLE) / (SELECT count(*) FROM f4)) / 1000 AS AnnualisedAvoidableCO2_t,
         AvoidableFuelCost_eur * (CAST({float(C.ANNUAL_FLIGHTS)} AS DOUBLE) / (SELECT count(*) FROM f4)) AS AnnualisedAvoidableCost_eur
  FROM f4
),
scale AS (SELECT CAST({float(C.ANNUAL_FLIGHTS)} AS DOUBLE) / count(*) AS _scale FROM flights)
"""
