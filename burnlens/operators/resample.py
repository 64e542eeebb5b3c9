"""Interval and density estimates that need one aggregate over the rows.

* Poisson bootstrap: in every replicate a row weighs Poisson(1), drawn from a hash of
  its key and the replicate.  Sums of weights and weighted values per group and
  replicate are all that is shuffled, so rows need no resampling and the draw does not
  depend on partitioning.
* Violin densities: values are shared out linearly over a grid of ``GRID`` points per
  group; the kernel runs over the grid, never over rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .sizing import measured_broadcast

REPLICATES = 200
#: Hashes live in the integers modulo this prime; multipliers of the replicates.
PRIME = 2**31 - 1
FIRST_MULTIPLIER, NEXT_MULTIPLIER = 48271, 1_234_567
GRID, CUT = 100, 2.0


def poisson_steps(most: int = 8) -> list[int]:
    """Where the weight goes up by one, of the numbers ``0 .. PRIME - 1``."""
    total, term, out = 0.0, math.exp(-1.0), []
    for k in range(most):
        total += term
        out.append(math.floor(total * PRIME))
        term /= k + 1
    return out


def key_hashes(key: str) -> tuple[Column, Column]:
    """Two numbers below ``PRIME`` from the md5 of the key."""
    md5 = F.md5(F.col(key).cast("string"))

    def part(at: int) -> Column:
        return F.conv(F.substring(md5, at, 8), 16, 10).cast("long") % F.lit(PRIME)

    return part(1), part(9)


def multiplier(replicate: Column) -> Column:
    return (F.lit(FIRST_MULTIPLIER) + replicate * F.lit(NEXT_MULTIPLIER)) % F.lit(PRIME)


def bootstrap_means(df: DataFrame, value: str, by: str, key: str, replicates: int = REPLICATES) -> DataFrame:
    """``(by, Replicate, Mean)`` of every replicate in which the group has a weight."""
    h1, h2 = key_hashes(key)
    rows = df.where(F.col(by).isNotNull() & F.col(value).isNotNull()).select(by, F.col(value).alias("_x"), h1.alias("_h1"), h2.alias("_h2"))
    rows = rows.withColumn("Replicate", F.explode(F.sequence(F.lit(0), F.lit(replicates - 1))))
    u = (F.col("_h1") * multiplier(F.col("Replicate").cast("long")) + F.col("_h2")) % F.lit(PRIME)
    weight = sum((F.when(u >= step, 1).otherwise(0) for step in poisson_steps()), F.lit(0))
    sums = rows.withColumn("_w", weight).where("_w > 0").groupBy(by, "Replicate").agg(F.sum("_w").alias("_n"), F.sum(F.col("_w") * F.col("_x")).alias("_s"))
    return sums.select(by, "Replicate", (F.col("_s") / F.col("_n")).alias("Mean"))


def bootstrap_interval(df: DataFrame, value: str, by: str, key: str, replicates: int = REPLICATES, level: float = 0.95) -> DataFrame:
    """Mean, rows and the percentile interval of the group's mean."""
    tail = (1 - level) / 2
    means = bootstrap_means(df, value, by, key, replicates)
    ends = means.groupBy(by).agg(
        F.percentile("Mean", F.lit(tail)).alias("CILow"), F.percentile("Mean", F.lit(1 - tail)).alias("CIHigh"), F.count("*").alias("Replicates")
    )  # at most ``replicates`` numbers a group
    plain = df.where(F.col(by).isNotNull()).groupBy(by).agg(F.avg(value).alias("Mean"), F.count(value).alias("Rows"))
    return plain.join(ends, by, "left")


def violin(df: DataFrame, value: str, by: str, grid: int = GRID, cut: float = CUT) -> DataFrame:
    """``(by, Point, X, Density)``, a Gaussian kernel density of every group on
    ``grid`` points from ``cut`` bandwidths below the smallest to as many above the
    largest value; the bandwidth is n^(-1/5) sample deviations.  Groups without spread
    have no density."""
    rows = df.where(F.col(by).isNotNull() & F.col(value).isNotNull()).select(by, F.col(value).cast("double").alias("_x"))
    shape = rows.groupBy(by).agg(F.count("*").alias("_n"), F.stddev_samp("_x").alias("_sd"), F.min("_x").alias("_lo"), F.max("_x").alias("_hi")).where("_sd > 0")
    bw = F.pow(F.col("_n"), F.lit(-0.2)) * F.col("_sd")
    shape = shape.withColumn("_bw", bw).withColumns({"_from": F.col("_lo") - cut * F.col("_bw"), "_step": (F.col("_hi") - F.col("_lo") + 2 * cut * F.col("_bw")) / (grid - 1)})
    shape = shape.select(by, "_n", "_bw", "_from", "_step")
    place = (F.col("_x") - F.col("_from")) / F.col("_step")
    left = F.least(F.floor(place), F.lit(grid - 2))
    share = place - left
    both = F.array(F.struct(left.alias("k"), (1 - share).alias("w")), F.struct((left + 1).alias("k"), share.alias("w")))
    binned = rows.join(measured_broadcast(shape), by).select(by, F.inline(both)).groupBy(by, "k").agg(F.sum("w").alias("w"))
    # At most ``grid`` entries a group.
    bins = binned.groupBy(by).agg(F.collect_list(F.struct("k", "w")).alias("_bins")).join(shape, by)
    points = bins.withColumn("Point", F.explode(F.sequence(F.lit(0), F.lit(grid - 1))))
    norm = F.col("_n") * F.col("_bw") * math.sqrt(2 * math.pi)
    kernel = F.aggregate(
        F.array_sort("_bins"),
        F.lit(0.0),
        lambda total, b: total + b["w"] * F.exp(-0.5 * F.pow((F.col("Point") - b["k"]) * F.col("_step") / F.col("_bw"), 2)),
    )
    return points.select(by, "Point", (F.col("_from") + F.col("Point") * F.col("_step")).alias("X"), (kernel / norm).alias("Density"))
