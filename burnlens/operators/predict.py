"""Train/validation split (ML1), fold ids (ML3) and the group-mean benchmark
model (J5/A10) that serves as the SQL-checkable prediction.

The split hashes a key with md5 (portable: DuckDB gives the same bits), so it
does not depend on partitioning the way ``randomSplit`` does, and rows that
share a key (one order's lines) land on the same side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C


def hash_bucket(key, buckets: int = 100):
    """0..buckets-1 from the first 32 bits of md5(key)."""
    k = F.col(key) if isinstance(key, str) else key
    return (F.conv(F.substring(F.md5(k.cast("string")), 1, 8), 16, 10).cast("long") % buckets).cast("int")


def hash_split(df: DataFrame, key: str = "OrderKey", validation_pct: int = C.SPLIT_VALIDATION_PCT) -> DataFrame:
    """Adds ``IsValidation`` (bucket < pct) and ``Fold`` (0..4) to every row."""
    b = hash_bucket(key)
    return df.withColumns({"IsValidation": b < validation_pct, "Fold": (b % C.N_FOLDS).cast("int")})


def exact_mean(c, scale: int = 6):
    """Order-independent mean: the sum is accumulated as DECIMAL(38, scale)
    (exact for values with at most ``scale`` decimals), so the result is the
    same on every run, partitioning and engine; float ``avg`` is not. NULL
    where there is no value."""
    x = F.col(c) if isinstance(c, str) else c
    total = F.sum(x.cast(f"decimal(38,{scale})")).cast("double")
    return total / F.nullif(F.count(x), F.lit(0))


def group_mean_model(train: DataFrame, by: str = "AircraftTypeGroup", target: str = C.TARGET,
                     name: str = "_pred") -> DataFrame:
    """Fit: mean target per group (one row per group; NULL groups dropped,
    as ``groupby`` does). The mean is exact (see ``exact_mean``) so the
    benchmark, and every residual built on it, is reproducible."""
    return train.where(F.col(by).isNotNull()).groupBy(by).agg(exact_mean(target).alias(name))


def apply_group_mean(df: DataFrame, model: DataFrame, by: str = "AircraftTypeGroup") -> DataFrame:
    """Predict: left lookup of the group mean (NULL for unseen groups).

    The model has one row per group value: it is counted and broadcast when
    under the row bound, so the fact is streamed, not shuffled by a key
    with a handful of values (the skew worst case)."""
    from .sizing import measured_broadcast

    return df.join(measured_broadcast(model), by, "left")


def with_benchmark(eng: DataFrame, by: str = "AircraftTypeGroup", target: str = C.TARGET) -> DataFrame:
    """Scored fact for the analytics layers: every engineered row gets
    ``PredictedBurn_kg`` (group mean of the training split) and
    ``BaselinePred_kg`` (group mean over all rows, the naive comparator)."""
    split = hash_split(eng)
    train = F.when(~F.col("IsValidation"), F.col(target))
    both = split.where(F.col(by).isNotNull()).groupBy(by).agg(
        exact_mean(train).alias("PredictedBurn_kg"), exact_mean(target).alias("BaselinePred_kg")
    )  # one pass for the two models
    return apply_group_mean(split, both, by)
