"""Group-mean models, leave-fold-out benchmarks, and a registry of saved models.

A registry is a folder with one manifest row for each saved model: what kind it is,
where its files are, its hold-out error, and a hash of the names and types of the
features it needs.  Scoring takes the first model of the ranking whose files are there
and whose hash is that of the data at hand; no data is read to find that out.
"""

from __future__ import annotations

import hashlib
import time
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .. import config as C
from ..sources import io
from .ml import LinearModel
from .predict import exact_mean
from .sizing import measured_broadcast, with_scalars

MANIFEST = "Model string, Kind string, Path string, Features array<string>, FeatureHash string, RMSE double, Saved long"
EXACT = "decimal(38,6)"


class NoUsableModel(RuntimeError):
    pass


def _known(df: DataFrame, keys: list[str]) -> DataFrame:
    for k in keys:
        df = df.where(F.col(k).isNotNull())
    return df


@dataclass
class GroupMean:
    """The mean target of the row's group, from fine to coarse keys; ``[]`` is the mean of all rows."""

    levels: list[list[str]]
    tables: list[DataFrame] = field(default_factory=list)

    @classmethod
    def fit(cls, train: DataFrame, levels: list[list[str]], target: str = C.TARGET) -> GroupMean:
        tables = [_known(train, keys).groupBy(*keys).agg(exact_mean(target).alias("_mean")) for keys in levels]
        return cls(levels, tables)

    def transform(self, df: DataFrame, name: str = "prediction") -> DataFrame:
        out = df
        for k, (keys, table) in enumerate(zip(self.levels, self.tables)):
            table = table.withColumnRenamed("_mean", f"_mean{k}")
            out = out.join(measured_broadcast(table), keys, "left") if keys else with_scalars(out, table)
        found = [f"_mean{k}" for k in range(len(self.levels))]
        return out.withColumn(name, F.coalesce(*found)).drop(*found)

    def features(self) -> list[str]:
        return sorted({k for keys in self.levels for k in keys})

    def save(self, path: str) -> None:
        for k, table in enumerate(self.tables):
            table.write.mode("overwrite").parquet(f"{path}/level-{k}")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> GroupMean:
        tables, k = [], 0
        while io.path_exists(spark, f"{path}/level-{k}"):
            tables.append(spark.read.parquet(f"{path}/level-{k}"))
            k += 1
        return cls([[c for c in t.columns if c != "_mean"] for t in tables], tables)


def leave_fold_out(df: DataFrame, levels: list[list[str]], name: str, target: str = C.TARGET, fold: str = "Fold") -> DataFrame:
    """A benchmark that never saw the row's fold: the group's total less that of its rows
    in the fold, from one aggregate of sums and counts by group and fold; coarser groups
    where a group lies in one fold only."""
    out, found = df, []
    for k, keys in enumerate(levels):
        by = [*keys, fold]
        sums = _known(df.where(F.col(target).isNotNull()), keys).groupBy(*by).agg(F.sum(F.col(target).cast(EXACT)).alias("_s"), F.count(target).alias("_n"))
        group = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))  # windows over groups x folds, not rows
        rest_n = F.sum("_n").over(group) - F.col("_n")
        rest = (F.sum("_s").over(group) - F.col("_s")).cast("double")
        table = sums.select(*by, F.when(rest_n > 0, rest / rest_n).alias(f"_out{k}"))
        out = out.join(measured_broadcast(table), by, "left")
        found.append(f"_out{k}")
    return out.withColumn(name, F.coalesce(*found)).drop(*found)


def fold_rmse(df: DataFrame, prediction: str, target: str = C.TARGET, fold: str = "Fold") -> float | None:
    """Mean over the folds of their root mean squared error."""
    e = F.col(prediction) - F.col(target)
    return df.groupBy(fold).agg(F.sqrt(F.avg(e * e)).alias("_r")).agg(F.avg("_r")).first()[0]


def with_primary(board: DataFrame, preferred: str | None = None) -> DataFrame:
    """ML12: marks the preferred model if it is there, else the one of the lowest RMSE.
    A board has a row for each model."""
    first = F.when(F.col("Model") == F.lit(preferred), 0).otherwise(1)
    return board.withColumn("Primary", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(first, "RMSE", "Model")) == 1)


def feature_hash(schema: StructType, features: list[str]) -> str | None:
    """Hash of the features' names and types; None if one is missing."""
    types = {f.name: f.dataType.simpleString() for f in schema.fields}
    if any(f not in types for f in features):
        return None
    return hashlib.sha256("\n".join(f"{f}:{types[f]}" for f in sorted(features)).encode()).hexdigest()


@dataclass
class Registry:
    spark: SparkSession
    folder: str

    def add(self, name: str, model, features: list[str], schema: StructType, rmse: float | None) -> None:
        """Save a model and its manifest row; a later row of a name replaces an earlier one."""
        path = f"{self.folder}/{name.lower().replace(' ', '-')}"
        if isinstance(model, GroupMean):
            kind = "group mean"
            model.save(path)
        elif isinstance(model, LinearModel):
            kind = "linear"
            model.save(path, self.spark)
        else:
            kind = "pipeline"
            model.write().overwrite().save(path)
        needed = feature_hash(schema, features)
        if needed is None:
            raise ValueError(f"the schema lacks features of {name}")
        row = [(name, kind, path, sorted(features), needed, rmse, time.time_ns())]
        self.spark.createDataFrame(row, MANIFEST).coalesce(1).write.mode("append").parquet(f"{self.folder}/manifest")

    def rows(self) -> list:
        """Manifest rows, best first (a few: one for each model)."""
        found = sorted(self.spark.read.schema(MANIFEST).parquet(f"{self.folder}/manifest").collect(), key=lambda r: r.Saved)
        return sorted({r.Model: r for r in found}.values(), key=lambda r: (r.RMSE is None, r.RMSE, r.Model))

    def first_usable(self, schema: StructType, preferred: str | None = None):
        """The manifest row to score with: ranked, its files there, its features those of the data."""
        reasons = []
        for r in sorted(self.rows(), key=lambda r: r.Model != preferred):
            if not io.path_exists(self.spark, r.Path):
                reasons.append(f"{r.Model}: no files")
            elif feature_hash(schema, r.Features) != r.FeatureHash:
                reasons.append(f"{r.Model}: other features")
            else:
                return r
        raise NoUsableModel("; ".join(reasons) or "the manifest is empty")

    def load(self, row):
        if row.Kind == "group mean":
            return GroupMean.load(self.spark, row.Path)
        return LinearModel.load(row.Path, self.spark, row.Model) if row.Kind == "linear" else PipelineModel.load(row.Path)

    def score(self, data: DataFrame, preferred: str | None = None) -> DataFrame:
        """ML14: ``data`` with ``prediction`` and ``Model``, by the first usable model."""
        row = self.first_usable(data.schema, preferred)
        return self.load(row).transform(data).withColumn("Model", F.lit(row.Model))


def submitted(scored: DataFrame, key: str) -> DataFrame:
    """ML16/S12: one row for each key: the prediction clipped at 0, to two decimals, and whether it was negative."""
    negative: Column = (F.col("prediction") < 0).alias("WasNegative")
    return io.submission(scored, key, "prediction", negative, "Model")
