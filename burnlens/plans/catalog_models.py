"""Queries of models, their registry, keyed predictions and leave-fold-out benchmarks."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from .. import config as C
from ..operators import ml, models, predict, residuals, rows, value
from ..session import checkpoint_dir, remove_at_exit
from . import stages
from .catalog import _eng, _vs_sql, query

#: Levels of the group-mean models, from fine to coarse.
_TYPE = [["AircraftTypeGroup"], []]
_ROUTE_TYPE = [["ScheduledRoute", "AircraftTypeGroup"], ["AircraftTypeGroup"], []]
_LEVELS = {"Global mean": [[]], "Mean by type": _TYPE, "Mean by route and type": _ROUTE_TYPE}
_RIDGE = "Ridge on take-off weight"
_RIDGE_FEATURE, _RIDGE_ALPHA = "PlannedTOW", 1.0

_MEAN = "CAST(sum(CAST(Burnoff AS DECIMAL(38,6))) AS DOUBLE) / count(Burnoff)"
_FIT_SQL = f"""
    t AS (SELECT * FROM splitf WHERE NOT IsValidation AND Burnoff IS NOT NULL),
    v AS (SELECT * FROM splitf WHERE IsValidation AND Burnoff IS NOT NULL),
    g0 AS (SELECT {_MEAN} AS p FROM t),
    g1 AS (SELECT AircraftTypeGroup, {_MEAN} AS p FROM t WHERE AircraftTypeGroup IS NOT NULL GROUP BY 1),
    g2 AS (SELECT ScheduledRoute, AircraftTypeGroup, {_MEAN} AS p FROM t WHERE ScheduledRoute IS NOT NULL AND AircraftTypeGroup IS NOT NULL GROUP BY 1, 2)
"""


def _predicted_sql(source: str) -> str:
    return f"""
      SELECT s.*, g0.p AS p_global, coalesce(g1.p, g0.p) AS p_type, coalesce(g2.p, g1.p, g0.p) AS p_route
      FROM {source} s CROSS JOIN g0 LEFT JOIN g1 ON g1.AircraftTypeGroup = s.AircraftTypeGroup
      LEFT JOIN g2 ON g2.ScheduledRoute = s.ScheduledRoute AND g2.AircraftTypeGroup = s.AircraftTypeGroup
    """


def _lfo_sql(source: str) -> str:
    """Leave-fold-out means of ``source``: ``o_global``, ``o_type``, ``o_route``."""
    parts, joins, found = [], [], []
    for k, keys in enumerate(_ROUTE_TYPE[::-1]):
        by = ", ".join([*keys, "Fold"])
        nn = " AND ".join([f"{c} IS NOT NULL" for c in keys] or ["true"])
        group = f"PARTITION BY {', '.join(keys)}" if keys else ""
        parts.append(
            f"s{k} AS (SELECT {by}, sum(CAST(Burnoff AS DECIMAL(38,6))) AS s, count(Burnoff) AS n FROM {source} WHERE Burnoff IS NOT NULL AND {nn} GROUP BY {by}), "
            f"o{k} AS (SELECT {by}, CASE WHEN sum(n) OVER ({group}) - n > 0 THEN CAST(sum(s) OVER ({group}) - s AS DOUBLE) / (sum(n) OVER ({group}) - n) END AS p FROM s{k})"
        )
        joins.append(f"LEFT JOIN o{k} ON " + " AND ".join(f"o{k}.{c} = x.{c}" for c in [*keys, "Fold"]))
        found.insert(0, f"o{k}.p")
    return (
        f"{', '.join(parts)}, lfo AS (SELECT x.*, o0.p AS o_global, coalesce({', '.join(found[1:])}) AS o_type, coalesce({', '.join(found)}) AS o_route "
        f"FROM {source} x {' '.join(joins)})"
    )


def _split(spark, sf):
    s = predict.hash_split(_eng(spark, sf)).where(F.col(C.TARGET).isNotNull())
    return s.where(~F.col("IsValidation")), s.where(F.col("IsValidation"))


def _fitted(train) -> dict:
    return {name: models.GroupMean.fit(train, levels) for name, levels in _LEVELS.items()}


def _board(val, fitted: dict, cv: dict | None = None):
    stacked = None
    for name, model in fitted.items():
        p = model.transform(val).select(F.col(C.TARGET).alias("label"), F.lit(name).alias("Model"), "prediction")
        stacked = p if stacked is None else stacked.unionByName(p)
    return models.with_primary(ml.scoreboard(stacked, cv))


def _metrics_sql(name: str, source: str, p: str) -> str:
    return f"""
      SELECT '{name}' AS Model, sqrt(avg(({p} - Burnoff) * ({p} - Burnoff))) AS RMSE, avg(abs({p} - Burnoff)) AS MAE,
             avg(abs({p} - Burnoff) / greatest(abs(Burnoff), CAST(2.220446049250313e-16 AS DOUBLE))) * 100 AS MAPE,
             1 - sum(({p} - Burnoff) * ({p} - Burnoff)) / (var_pop(Burnoff) * count(Burnoff)) AS R2 FROM {source}
    """


def _cv_sql(name: str, source: str, p: str) -> str:
    return f"SELECT '{name}' AS Model, (SELECT avg(r) FROM (SELECT sqrt(avg(({p} - Burnoff) * ({p} - Burnoff))) AS r FROM {source} GROUP BY Fold)) AS CV_RMSE"


_X = _RIDGE_FEATURE
_RIDGE_SQL = f"""
    rs AS (SELECT avg({_X}) AS mu, stddev_pop({_X}) AS sd, avg(Burnoff) AS yb FROM t),
    rc AS (SELECT mu, sd, yb, sum(({_X} - mu) / sd * (Burnoff - yb)) / (sum(({_X} - mu) / sd * (({_X} - mu) / sd)) + {_RIDGE_ALPHA}) AS w FROM rs, t GROUP BY mu, sd, yb),
    rv AS (SELECT v.Burnoff, yb + w * ({_X} - mu) / sd AS p FROM v, rc),
    fk AS (SELECT DISTINCT Fold AS k FROM t),
    fs AS (SELECT k, avg({_X}) AS mu, stddev_pop({_X}) AS sd, avg(Burnoff) AS yb FROM fk JOIN t ON t.Fold <> fk.k GROUP BY k),
    fc AS (SELECT k, mu, sd, yb, sum(({_X} - mu) / sd * (Burnoff - yb)) / (sum(({_X} - mu) / sd * (({_X} - mu) / sd)) + {_RIDGE_ALPHA}) AS w FROM fs JOIN t ON t.Fold <> fs.k GROUP BY k, mu, sd, yb),
    fr AS (SELECT t.Fold, t.Burnoff, yb + w * ({_X} - mu) / sd AS p FROM t JOIN fc ON fc.k = t.Fold)
"""


@query(
    "model_scoreboard",
    f"""
    WITH {_FIT_SQL}, pv AS ({_predicted_sql('v')}), {_lfo_sql('t')}, {_RIDGE_SQL},
    m AS ({_metrics_sql('Global mean', 'pv', 'p_global')} UNION ALL {_metrics_sql('Mean by type', 'pv', 'p_type')}
          UNION ALL {_metrics_sql('Mean by route and type', 'pv', 'p_route')} UNION ALL {_metrics_sql(_RIDGE, 'rv', 'p')}),
    c AS ({_cv_sql('Global mean', 'lfo', 'o_global')} UNION ALL {_cv_sql('Mean by type', 'lfo', 'o_type')}
          UNION ALL {_cv_sql('Mean by route and type', 'lfo', 'o_route')} UNION ALL {_cv_sql(_RIDGE, 'fr', 'p')}),
    r AS (SELECT Model, round_even(RMSE, 2) AS RMSE, round_even(MAE, 2) AS MAE, round_even(MAPE, 3) AS MAPE, round_even(R2, 4) + 0.0 AS R2, round_even(CV_RMSE, 2) AS CV_RMSE
          FROM m JOIN c USING (Model))
    SELECT *, round_even(RMSE - CV_RMSE, 2) AS CVGap, row_number() OVER (ORDER BY RMSE, Model) = 1 AS "Primary" FROM r
    """,
    "Model, RMSE:d, MAE:d, MAPE:d, R2:d, CV_RMSE:d, CVGap:d, Primary",
)
def model_scoreboard(spark, sf):
    """ML10/ML11/ML12/A17/A37: hold-out and cross-validated errors of the group means and of a ridge, and the primary model."""
    train, val = _split(spark, sf)
    fitted, cv = _fitted(train), {}
    out = train
    for k, (name, levels) in enumerate(_LEVELS.items()):
        out = models.leave_fold_out(out, levels, f"_cv{k}")
    for k, name in enumerate(_LEVELS):
        cv[name] = models.fold_rmse(out, f"_cv{k}")
    ridge_rows = train.where(F.col(_RIDGE_FEATURE).isNotNull()).withColumn("label", F.col(C.TARGET))
    ridge = ml.ridge_closed_form_cv(ridge_rows, [_RIDGE_ALPHA], [_RIDGE_FEATURE], [])
    return _board(val, fitted | {_RIDGE: ridge.model}, cv | {_RIDGE: ridge.cv_rmse})


@query(
    "linear_importance",
    f"""
    WITH {_FIT_SQL},
    s AS (SELECT avg(PlannedTOW) AS ma, stddev_pop(PlannedTOW) AS sa, avg(PlannedTripTime) AS mb, stddev_pop(PlannedTripTime) AS sb, avg(Burnoff) AS my FROM t),
    z AS (SELECT (PlannedTOW - ma) / sa AS a, (PlannedTripTime - mb) / sb AS b, Burnoff - my AS y FROM t, s),
    q AS (SELECT sum(a * a) + {_RIDGE_ALPHA} AS aa, sum(b * b) + {_RIDGE_ALPHA} AS bb, sum(a * b) AS ab, sum(a * y) AS ay, sum(b * y) AS bys FROM z),
    w AS (SELECT abs((bb * ay - ab * bys) / (aa * bb - ab * ab)) AS wa, abs((aa * bys - ab * ay) / (aa * bb - ab * ab)) AS wb FROM q),
    i AS (SELECT 'PlannedTOW' AS Feature, wa / (wa + wb) AS Importance FROM w UNION ALL SELECT 'PlannedTripTime', wb / (wa + wb) FROM w)
    SELECT 'Ridge Regression' AS Model, Feature, Importance, CAST(row_number() OVER (ORDER BY Importance DESC, Feature) AS INTEGER) AS Rank FROM i
    """,
    "Model, Feature, Importance:d, Rank",
)
def linear_importance(spark, sf):
    """ML13/W2/W4: shares of the absolute standardised coefficients of a ridge, ranked."""
    train, _ = _split(spark, sf)
    fitted = ml.ridge_closed_form_cv(train.withColumn("label", F.col(C.TARGET)), [_RIDGE_ALPHA], ["PlannedTOW", "PlannedTripTime"], [])
    return ml.feature_importance([fitted], train).select("Model", "Feature", "Importance", "Rank")


_SCORING_SQL = f"""
    {_FIT_SQL}, pv AS ({_predicted_sql('v')}),
    m AS ({_metrics_sql('Global mean', 'pv', 'p_global')} UNION ALL {_metrics_sql('Mean by type', 'pv', 'p_type')}
          UNION ALL {_metrics_sql('Mean by route and type', 'pv', 'p_route')}),
    best AS (SELECT Model FROM m ORDER BY round_even(RMSE, 2), Model LIMIT 1),
    every AS (SELECT * FROM raw WHERE CAST((('0x' || substr(md5(CAST(OrderKey AS VARCHAR)), 1, 8))::BIGINT % 100) AS INTEGER) < {C.SPLIT_VALIDATION_PCT}),
    sc AS (SELECT e.*, Model, CASE Model WHEN 'Global mean' THEN p_global WHEN 'Mean by type' THEN p_type ELSE p_route END AS prediction
           FROM ({_predicted_sql('every')}) e CROSS JOIN best)
"""


def _registry(spark, sf) -> models.Registry:
    """The group-mean models, saved with their hold-out errors."""
    train, val = _split(spark, sf)
    fitted = _fitted(train)
    folder = f"{checkpoint_dir(spark)}/burnlens/models-{uuid.uuid4().hex}"
    remove_at_exit(spark, folder)
    registry = models.Registry(spark, folder)
    errors = {r.Model: r.RMSE for r in _board(val, fitted).collect()}  # a row for each model
    for name, model in fitted.items():
        registry.add(name, model, model.features(), train.schema, errors[name])
    return registry


def _scored_by_key(spark, sf):
    """Every row of the validation orders, whatever its target: the scoring variant of
    the features, gaps filled from the rows themselves, and the first usable model."""
    every = stages.scoring_rows(spark, sf)
    rows.require_unique(every, "RowKey")
    registry = _registry(spark, sf)
    filled = ml.impute_for_scoring(every, [], ["ScheduledRoute", "AircraftTypeGroup"])
    return every, registry.score(filled)


@query("submission", f"WITH {_SCORING_SQL} SELECT RowKey, round_even(greatest(prediction, 0.0) * 100, 0) / 100 AS Burnoff, prediction < 0 AS WasNegative, Model FROM sc",
       "RowKey, Burnoff, WasNegative, Model")
def submission(spark, sf):
    """C1/ML14/ML15/ML16/S12/S13: submission of the scoring rows, one for each key, by the registry's best usable model."""
    return models.submitted(_scored_by_key(spark, sf)[1], "RowKey")


@query(
    "keyed_errors",
    f"""
    WITH {_SCORING_SQL}
    SELECT s.AircraftTypeGroup, count(*) AS Flights, sqrt(avg((s.prediction - e.Burnoff) * (s.prediction - e.Burnoff))) AS RMSE, avg(s.prediction - e.Burnoff) AS MeanBias
    FROM sc s JOIN eng e ON e.RowKey = s.RowKey GROUP BY 1
    """,
    "AircraftTypeGroup, Flights, RMSE:d, MeanBias:d",
)
def keyed_errors(spark, sf):
    """Predictions joined to actuals by row key, with the type attached from the scoring rows' metadata."""
    every, scored = _scored_by_key(spark, sf)
    keyed = scored.select("RowKey", "prediction").join(every.select("RowKey", "AircraftTypeGroup"), "RowKey")
    e = F.col("prediction") - F.col(C.TARGET)
    # a key begins with its order: only rows of the validation orders can match
    actual = predict.hash_split(_eng(spark, sf)).where(F.col("IsValidation"))
    both = keyed.join(actual.select("RowKey", C.TARGET), "RowKey")
    return both.groupBy("AircraftTypeGroup").agg(F.count("*").alias("Flights"), F.sqrt(F.avg(e * e)).alias("RMSE"), F.avg(e).alias("MeanBias"))


@query(
    "row_identity",
    "SELECT count(*) AS Rows, count(DISTINCT RowKey) AS Keys, CAST(0 AS BIGINT) AS RepeatedKeys, CAST(0 AS BIGINT) AS NullKeys, "
    "count(*) AS Numbers, CAST(0 AS BIGINT) AS FirstNumber, count(*) - 1 AS LastNumber FROM eng",
    "Rows, Keys, RepeatedKeys, NullKeys, Numbers, FirstNumber, LastNumber",
)
def row_identity(spark, sf):
    """S3: the row key is unique, and dense row numbers cover 0 to n - 1, each once."""
    from ..operators.sizing import with_scalars

    eng = _eng(spark, sf).select("RowKey")
    numbered = rows.number_rows(eng)
    numbers = numbered.agg(F.count_distinct("RowNumber").alias("Numbers"), F.min("RowNumber").alias("FirstNumber"), F.max("RowNumber").alias("LastNumber"))
    return with_scalars(rows.key_report(eng, "RowKey"), numbers)


_HONEST_SQL = f"""
    WITH {_lfo_sql('splitf')},
    lf AS (
      SELECT Burnoff AS ActualBurn_kg, o_route AS PredictedBurn_kg, o_type AS BaselinePred_kg,
             greatest(Burnoff - o_route, 0.0) * CAST({C.CO2_PER_KG_FUEL} AS DOUBLE) AS AvoidableCO2_kg,
             greatest(Burnoff - o_route, 0.0) * CAST({C.FUEL_PRICE_PER_KG} AS DOUBLE) AS AvoidableFuelCost_eur,
             greatest(TeledyneRampWeight - PlannedZeroFuelWeight - o_route, 0.0) * CAST({C.FUEL_CARRY_PENALTY} AS DOUBLE) * CAST({C.FUEL_PRICE_PER_KG} AS DOUBLE) AS CarryPenaltyCost_eur
      FROM lfo WHERE Burnoff IS NOT NULL
    )
    SELECT * FROM ({_vs_sql().replace('FROM flights', 'FROM lf').replace("'GroupMean'", "'Mean by route and type, other folds'")})
"""


@query("value_summary_other_folds", _HONEST_SQL, "Ord, Metric, Value:d, ValueText")
def value_summary_other_folds(spark, sf):
    """The value table with benchmarks that never saw a row's fold: the route
    and type mean against the naive type mean."""
    eng = predict.hash_split(_eng(spark, sf)).where(F.col(C.TARGET).isNotNull())
    out = models.leave_fold_out(eng, _ROUTE_TYPE, "PredictedBurn_kg")
    out = models.leave_fold_out(out, _TYPE, "BaselinePred_kg")
    flights = value.emissions_and_cost(value.flight_residuals(out))
    return value.value_summary(flights, "Mean by route and type, other folds")


@query(
    "other_fold_errors",
    f"""
    WITH {_lfo_sql('splitf')},
    m AS ({_metrics_sql('Mean by type', 'lfo', 'o_type')} UNION ALL {_metrics_sql('Mean by route and type', 'lfo', 'o_route')})
    SELECT Model AS Label, round_even(RMSE, 2) AS RMSE, round_even(MAPE, 3) AS MAPE, round_even(R2, 4) + 0.0 AS R2 FROM m
    """,
    "Label, RMSE:d, MAPE:d, R2:d",
)
def other_fold_errors(spark, sf):
    """Baseline against model over all rows, each predicted from the other folds."""
    eng = predict.hash_split(_eng(spark, sf)).where(F.col(C.TARGET).isNotNull())
    out = models.leave_fold_out(models.leave_fold_out(eng, _ROUTE_TYPE, "_route"), _TYPE, "_type")
    return residuals.metrics_long(out, C.TARGET, {"Mean by type": "_type", "Mean by route and type": "_route"})


#: Two-feature ridges whose importances the consensus is taken over.
_CONSENSUS_FEATURES = ["PlannedTOW", "PlannedTripTime", "RouteDistanceKm", "LoadFactor"]
_PAIRS = [(a, b) for k, a in enumerate(_CONSENSUS_FEATURES) for b in _CONSENSUS_FEATURES[k + 1 :]]


def _pair_sql(a: str, b: str) -> str:
    return f"""
      SELECT '{a} + {b}' AS Model, unnest(['{a}', '{b}']) AS Feature, unnest([wa, wb]) AS Importance
      FROM (SELECT abs(bb * ay - ab * bys) AS wa, abs(aa * bys - ab * ay) AS wb
            FROM (SELECT sum(a * a) + {_RIDGE_ALPHA} AS aa, sum(b * b) + {_RIDGE_ALPHA} AS bb, sum(a * b) AS ab, sum(a * y) AS ay, sum(b * y) AS bys
                  FROM (SELECT ({a} - (SELECT avg({a}) FROM t)) / (SELECT stddev_pop({a}) FROM t) AS a,
                               ({b} - (SELECT avg({b}) FROM t)) / (SELECT stddev_pop({b}) FROM t) AS b, Burnoff - (SELECT avg(Burnoff) FROM t) AS y FROM t)))
    """


@query(
    "importance_consensus",
    f"""
    WITH {_FIT_SQL}, i AS ({' UNION ALL '.join(_pair_sql(a, b) for a, b in _PAIRS)}),
    r AS (SELECT *, row_number() OVER (PARTITION BY Model ORDER BY Importance DESC, Feature) AS Rank FROM i),
    c AS (SELECT Feature, count(DISTINCT Model) AS Models, avg(Rank) AS AvgRank FROM r GROUP BY 1)
    SELECT * FROM (SELECT *, CAST(row_number() OVER (ORDER BY Models DESC, AvgRank, Feature) AS INTEGER) AS Position FROM c) WHERE Position <= 3
    """,
    "Feature, Models, AvgRank:d, Position",
)
def importance_consensus(spark, sf):
    """The three features that most ridges rank, by the importances of six two-feature models."""
    train, _ = _split(spark, sf)
    rows_ = train.withColumn("label", F.col(C.TARGET))
    fitted = []
    for a, b in _PAIRS:
        f = ml.ridge_closed_form_cv(rows_, [_RIDGE_ALPHA], [a, b], [])
        fitted.append(ml.Fitted(f"{a} + {b}", f.model, f.cv_rmse, f.search))
    return ml.importance_consensus(ml.feature_importance(fitted, train))
