"""Stage plans: the reference's script chain as lazily composed DataFrames,
with the two hand-off tables (engineered fact, scored flights) written once
as Parquet under the shared checkpoint folder.

raw fact --C1--> engineered --(split, benchmark model)--> scored flights
        (stage 1)                                   (stage 6: C6, C7, C8, C9, C10)

Writing the hand-off tables cuts lineage: a lost executor re-reads Parquet
instead of recomputing the star join, and every later query gets column
pruning and filter pushdown on a columnar copy.

Only what a row can't give again is written: the joined source columns, the
columns of few values, and for the scored flights the benchmark and segment of
every combination of the keys they depend on. Sums, differences and ratios of these
are columns of the view that is read; of them a query computes those it names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..operators import features, predict, segments, value
from ..session import materialize
from ..sources import airports as A
from ..sources import bind

_CACHE: dict[tuple, DataFrame] = {}


def _key(spark: SparkSession, sf_dir: str, stage: str) -> tuple:
    return (spark.sparkContext.applicationId, sf_dir.rstrip("/"), stage)


def airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.airports_from_nations(spark, sf_dir)


def engineered_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.engineer_features(bind.raw_fact(spark, sf_dir), airports(spark, sf_dir))


#: Engineered columns that are written beside the source columns.
WRITTEN_FEATURES = [
    "ScheduledRoute", "AircraftTypeGroup", "DepartureHour", "DepartureMonth", "DepartureYear",
    "DepartureDayOfWeek", "Season", "Origin", "Destination", "DistanceImputed", "RouteDistanceKm",
]
#: Columns of the scored flights that take other rows to compute, beside the split's.
ROW_SCORES = ["PredictedBurn_kg", "BaselinePred_kg", *segments.BASIS_COLUMNS]
WRITTEN_SCORES = ["IsValidation", "Fold", *ROW_SCORES]
#: Bytes of the combinations of keys that every executor may hold, and of one beside its strings.
COMBINATION_BYTES, COMBINATION_ROW_BYTES = 64 * 1024 * 1024, 120


def engineered_columns(written: DataFrame, kept: list[str], with_target: bool = True) -> DataFrame:
    """The engineered table over its written columns (or the scoring variant, without the
    target), with the columns ``kept`` beside it."""
    raw = [F.col(c) if c in WRITTEN_FEATURES else e.alias(c) for c, e in bind.raw_columns().items()]
    derived = [c for c in WRITTEN_FEATURES if c not in bind.RAW_COLUMNS]
    out = features.load_features(written.select(*raw, *derived, *kept))
    return features.burn_rate(out) if with_target else out.drop(C.TARGET)


def engineered(spark: SparkSession, sf_dir: str, reuse: bool = True, with_source: bool = False) -> DataFrame:
    """Stage 1 output (train_engineered), written once per session."""
    k = _key(spark, sf_dir, "engineered")
    if not (reuse and k in _CACHE):
        full = features.engineer_features(bind.raw_fact(spark, sf_dir, with_source=True), airports(spark, sf_dir))
        written = materialize(full.select(*bind.SOURCE_COLUMNS, *WRITTEN_FEATURES), "engineered")
        _CACHE[k] = engineered_columns(written, bind.SOURCE_COLUMNS)
    return _CACHE[k] if with_source else _CACHE[k].drop(*bind.SOURCE_COLUMNS)


def scoring_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scoring variant of the features for the rows of the validation orders, written."""
    fact = bind.raw_fact(spark, sf_dir, with_source=True)
    full = features.engineer_features(fact, airports(spark, sf_dir), with_target=False)
    split = ["IsValidation", "Fold"]
    rows = predict.hash_split(full).where(F.col("IsValidation"))
    written = materialize(rows.select(*bind.SOURCE_COLUMNS, *WRITTEN_FEATURES, *split), "scoring")
    return engineered_columns(written, split, with_target=False)


def valued_plan(bench: DataFrame, econ: C.Economics = C.Economics()) -> DataFrame:
    """Stage 6a, within a row: residuals, money / CO2, bands."""
    return value.bands(value.emissions_and_cost(value.flight_residuals(bench), econ))


def zscored_plan(eng: DataFrame, econ: C.Economics = C.Economics(), rules: C.AnomalyRules = C.AnomalyRules()) -> DataFrame:
    """Stage 6a: benchmark, residuals, money / CO2, bands, segment z-scores."""
    df = valued_plan(predict.with_benchmark(eng), econ)
    return segments.segment_zscores(df, rules.z_specs, min_size=rules.min_segment)


def classified_plan(z: DataFrame, econ: C.Economics = C.Economics(), rules: C.AnomalyRules = C.AnomalyRules()) -> DataFrame:
    """Stage 6b: anomaly labels (global exact 99.5 % cut) and annualisation."""
    return value.annualise(value.classify_anomalies(z, rules), econ)


def scored_plan(eng: DataFrame, econ: C.Economics = C.Economics(), rules: C.AnomalyRules = C.AnomalyRules()) -> DataFrame:
    """Stage 6 flight-level layer over any engineered frame (lazy, unwritten)."""
    return classified_plan(zscored_plan(eng, econ, rules), econ, rules)


def score_keys(rules: C.AnomalyRules) -> list[str]:
    """The columns that tell a row's benchmark and segment."""
    return list(dict.fromkeys(["AircraftTypeGroup", *(c for _, cols in rules.z_specs for c in cols)]))


def with_scores(eng: DataFrame, rules: C.AnomalyRules = C.AnomalyRules()) -> DataFrame:
    """``SOURCE_COLUMNS``, ``WRITTEN_FEATURES`` and ``WRITTEN_SCORES`` of the engineered rows.

    Benchmark and segment follow from a few key columns, so they are written once for
    each combination of these, and a row looks its own up. Where the combinations are too
    many to broadcast, the rows are written with their scores."""
    df = valued_plan(predict.with_benchmark(eng))
    keys = score_keys(rules)
    combinations = df.select(*keys, "PredictedBurn_kg", "BaselinePred_kg").distinct()
    scores = segments.segment_basis(df, rules.z_specs, min_size=rules.min_segment, of=combinations)
    scores = materialize(scores.select(*[F.col(c).alias(f"_k_{c}") for c in keys], *ROW_SCORES), "scored")
    size = sum((F.coalesce(F.length(f"_k_{c}"), F.lit(0)) for c in keys), F.lit(COMBINATION_ROW_BYTES))
    few = (scores.agg(F.sum(size)).first()[0] or 0) <= COMBINATION_BYTES
    rows = value.bands(predict.hash_split(eng))
    same = [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in keys]
    rows = rows.join(F.broadcast(scores) if few else scores, same, "left")
    rows = rows.select(*bind.SOURCE_COLUMNS, *WRITTEN_FEATURES, *WRITTEN_SCORES)
    return rows if few else materialize(rows, "scored")


def scored(spark: SparkSession, sf_dir: str, reuse: bool = True) -> DataFrame:
    """Stage 6 flight_analytics (all engineered rows, with prediction).

    The passes of the global exact quantile and the later queries scan the engineered
    rows and look up benchmark and segment (``with_scores``). The data-issue cut and the
    annual scale are a row each, written as well."""
    k = _key(spark, sf_dir, "scored")
    if reuse and k in _CACHE:
        return _CACHE[k]
    rules = C.AnomalyRules()
    rows = with_scores(engineered(spark, sf_dir, reuse, with_source=True), rules)
    z = segments.zscores_of_basis(valued_plan(engineered_columns(rows, WRITTEN_SCORES)))
    cut = materialize(value.data_issue_cut(z, rules), "cut")
    scale = materialize(value.annual_scale(z), "scale")
    df = value.annualise(value.classify_anomalies(z, rules, cut), scale=scale)
    _CACHE[k] = df
    return df


def reset_cache() -> None:
    _CACHE.clear()
