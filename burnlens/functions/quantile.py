"""Exact per-group quantiles without gathering a group into one task.

pandas ``quantile`` (linear interpolation, NULLs skipped) is what the reference
uses for medians, P90s, the 99.5 % data-issue cut and box summaries. Spark's
exact ``percentile`` merges a value->count map of the *whole group* in one task,
which does not survive a key holding a third of 100 TB. The same exact answer
comes from counts alone:

1. per (group, bucket): how many values, the smallest and the largest. A bucket
   is a fixed, order-preserving cut of the doubles (``BUCKETS`` per factor of
   two), so this is one partially aggregated pass whatever the distribution.
2. the counts are cumulated over a group's *buckets*. The bucket that holds a
   wanted rank is known then; if all its values are equal (ties) or the rank
   is its first or last, so is the order statistic.
3. else only that bucket's values are counted, value by value, and cumulated
   over its *distinct values*.

Windows see buckets or distinct values, never rows: a value that occurs in 90 %
of the rows is one counted row. Nothing is cached, and the result equals
``percentile`` / ``quantile_cont``.

Without groups the wanted ranks are a few rows and are broadcast. With groups
their number is only known from the data: by default the last step is a shuffle
join and nothing runs while the plan is built; with ``write`` the wanted ranks (two
short rows per group and quantile) are written once after step 2, so that the
counts are computed once and step 3 broadcasts them if they are small: the second
pass over the rows is then a filter, without a shuffle of the rows.

Many groups with fine buckets would make step 1 shuffle about as many counts as
there are rows. So with ``write`` its buckets are coarse (``COARSE_BUCKETS``), and
only where one with a wanted rank holds over ``OPEN_ROWS`` rows, the rows of such
buckets are counted once more, by fine buckets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.sizing import BROADCAST_BYTES, scan_bytes
from ..session import materialize

#: Buckets per factor of two, and an offset that makes every exponent positive.
BUCKETS, EXPONENTS = 4096, 1100
#: The same for a first cut of many groups, and the rows up to which its buckets are
#: counted value by value.
COARSE_BUCKETS, OPEN_ROWS = 16, 2_000_000


def bucket(v: Column, buckets: int = BUCKETS) -> Column:
    """Order-preserving bucket number of a double. An exponent that rounds to a
    neighbour moves the fraction by a whole octave, so the number stays right."""
    size = F.abs(v)
    exponent = F.floor(F.log2(size))
    fraction = size / F.pow(F.lit(2.0), exponent.cast("double")) - 1
    number = (exponent + EXPONENTS) * buckets + F.floor(fraction * buckets) + 1
    number = F.when(size == float("inf"), F.lit(3000 * buckets)).otherwise(number)
    return F.when(v == 0, F.lit(0)).when(v > 0, number).otherwise(-number).cast("long")


def _same(keys: list[str]) -> Column:
    out = F.lit(True)
    for c in keys:
        out = out & F.col(c).eqNullSafe(F.col(f"_k_{c}"))
    return out


def _renamed(keys: list[str]) -> list[Column]:
    return [F.col(c).alias(f"_k_{c}") for c in keys]


def _bucket_counts(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Rows and extreme values of every bucket ``order`` of the keys, and the rows before it."""
    counts = rows.groupBy(*keys, order).agg(F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_low"), F.max("_v").alias("_high"))
    in_order = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("_before", F.coalesce(F.sum("_n").over(in_order), F.lit(0)))


def _hits(counts: DataFrame, keys: list[str]) -> DataFrame:
    """The wanted ranks ``_rank`` that lie in their row's bucket: their place there, and
    the value if the bucket tells it."""
    here = counts.where((F.col("_rank") >= F.col("_before")) & (F.col("_rank") < F.col("_before") + F.col("_n")))
    here = here.withColumn("_at", F.col("_rank") - F.col("_before"))
    known = F.when((F.col("_at") == 0) | (F.col("_low") == F.col("_high")), F.col("_low")).when(F.col("_at") == F.col("_n") - 1, F.col("_high"))
    return here.select(*keys, "_slot", "_part", "_at", "_n", known.alias("_value"))


def _open(hits: DataFrame, keys: list[str], few: bool) -> tuple[DataFrame, DataFrame]:
    """Buckets with a wanted rank somewhere inside, each once, and these ranks."""
    inside = hits.where(F.col("_value").isNull())
    buckets = inside.select(*_renamed(keys)).distinct()
    ranks = inside.select(*_renamed(keys), "_slot", "_part", F.col("_at").alias("_rank"))
    return (F.broadcast(buckets), F.broadcast(ranks)) if few else (buckets, ranks)


def exact_quantiles(df: DataFrame, value: str, probs: dict[str, float], by: list[str] | None = None, write: bool = False) -> DataFrame:
    """One row per group of ``by`` (one row overall when empty) with a column
    per entry of ``probs`` holding the exact linear-interpolated quantile.

    Groups whose values are all NULL / NaN get no row (callers left-join). NULL group keys form
    their own group, as in ``groupBy``; callers drop them when needed.
    """
    by = list(by or [])
    write = write and bool(by)
    # NULL and NaN are both "missing" (pandas semantics); -0.0 is 0.0.
    base = df.select(*by, (F.col(value).cast("double") + F.lit(0.0)).alias("_v")).where(
        F.col("_v").isNotNull() & ~F.isnan("_v")
    ).withColumn("_bucket", bucket(F.col("_v"), COARSE_BUCKETS if write else BUCKETS))

    counts = _bucket_counts(base, by, "_bucket").withColumn("_total", F.sum("_n").over(Window.partitionBy(*by)))
    # Wanted ranks: the order statistic at or below each quantile, and the next.
    wanted = []
    for i, p in enumerate(probs.values()):
        h = (F.col("_total") - 1).cast("double") * F.lit(float(p))
        for side in (0, 1):
            rank = F.least(F.floor(h) + side, F.col("_total") - 1)
            wanted.append(F.struct(F.lit(2 * i + side).alias("_slot"), rank.alias("_rank"), (h - F.floor(h)).alias("_part")))
    keys = [*by, "_bucket"]
    hits = _hits(counts.select("*", F.inline(F.array(*wanted))), keys)
    few = not by  # two rows per quantile
    found = None
    if write:
        hits = materialize(hits, "ranks")
        few = scan_bytes(hits) <= BROADCAST_BYTES
        if (hits.where(F.col("_value").isNull()).agg(F.max("_n")).first()[0] or 0) > OPEN_ROWS:
            # too many for a count value by value: the same once more, by fine buckets
            found = hits.where(F.col("_value").isNotNull()).select(*by, "_slot", "_part", "_value")
            buckets, ranks = _open(hits, keys, few)
            base = base.join(buckets, _same(keys), "left_semi").withColumn("_fine", bucket(F.col("_v")))
            counts = _bucket_counts(base, keys, "_fine").join(ranks, _same(keys)).drop(*[f"_k_{c}" for c in keys])
            keys = [*keys, "_fine"]
            hits = materialize(_hits(counts, keys), "ranks")
            few = scan_bytes(hits) <= BROADCAST_BYTES

    # Buckets that hold a rank somewhere inside: count their distinct values.
    buckets, ranks = _open(hits, keys, few)
    inside = base.join(buckets, _same(keys), "left_semi")
    values = inside.groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_n"))
    in_order = Window.partitionBy(*keys).orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
    values = values.withColumn("_before", F.coalesce(F.sum("_n").over(in_order), F.lit(0)))
    ranked = values.join(ranks, _same(keys)).where(
        (F.col("_rank") >= F.col("_before")) & (F.col("_rank") < F.col("_before") + F.col("_n"))
    )
    told = hits.where(F.col("_value").isNotNull()).select(*by, "_slot", "_part", "_value")
    found = told if found is None else found.unionByName(told)
    found = found.unionByName(ranked.select(*by, "_slot", "_part", F.col("_v").alias("_value")))

    picks = []
    for i in range(len(probs)):
        for side in (0, 1):
            picks.append(F.max(F.when(F.col("_slot") == 2 * i + side, F.col("_value"))).alias(f"_s{2 * i + side}"))
        picks.append(F.max(F.when(F.col("_slot") == 2 * i, F.col("_part"))).alias(f"_p{i}"))
    out = found.groupBy(*by).agg(*picks)
    cols = []
    for i, name in enumerate(probs):
        a, b, part = F.col(f"_s{2 * i}"), F.col(f"_s{2 * i + 1}"), F.col(f"_p{i}")
        cols.append(F.when((part == 0) | (a == b), a).otherwise(a + part * (b - a)).alias(name))
    return out.select(*by, *cols)
