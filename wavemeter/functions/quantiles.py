"""Quantiles: mergeable KLL sketches and an exact percentile for groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


# A sketch of this size keeps about the precision of a 1024-value reservoir.
SKETCH_K = 1024

# Ranges for every e-fold of a value: neighbours in a range differ by some hundred thousandths.
RANGES = 65_536


def value_sketch(value: str | Column) -> Column:
    return F.kll_sketch_agg_double(value, F.lit(SKETCH_K))


def merge_sketches(sketch: str | Column) -> Column:
    return F.kll_merge_agg_double(sketch, F.lit(SKETCH_K))


def sketch_quantile(sketch: str | Column, rank: float) -> Column:
    return F.kll_sketch_get_quantile_double(sketch, F.lit(rank))


def exact_percentile(
    df: DataFrame, keys: Sequence[str], value: str, p: Column | float, out: str, ranges: int = RANGES
) -> DataFrame:
    """``(keys, out)`` with the exact interpolated percentile of ``value`` per group.

    ``p`` may be a column that is constant within a group. Nulls are left out.
    """
    fraction = p if isinstance(p, Column) else F.lit(float(p))
    rows = df.where(F.col(value).isNotNull()).select(
        *keys, F.col(value).cast("double").alias("__v"), fraction.cast("double").alias("__p")
    )
    weighted = rows.groupBy(*keys, "__v").agg(F.count(F.lit(1)).alias("__w"), F.max("__p").alias("__p"))
    return weighted_percentile(weighted, keys, out, ranges)


def weighted_percentile(
    weighted: DataFrame, keys: Sequence[str], out: str, ranges: int = RANGES
) -> DataFrame:
    """As :func:`exact_percentile`, of distinct values ``__v`` with their rows ``__w`` and fraction ``__p``.

    One plan serves groups of any size, and nothing is counted beforehand. A histogram by ranges
    of value brackets the wanted ranks; only what lies in their one or two ranges is put in
    order. The ranges follow from the values alone, so retries find the same ones; they decide how much
    is left to order, never the answer. A hot group is spread by its values until it is a histogram.
    """
    # One struct in place of many keys keeps the plan small; null fields of a struct are equal.
    ranged = weighted.select(
        F.struct(*keys).alias("__k"), "__v", "__w", "__p", _range(F.col("__v"), ranges).alias("__range")
    )
    counts = ranged.groupBy("__k", "__range").agg(F.sum("__w").alias("__rows"), F.max("__p").alias("__q"))
    group = W.partitionBy("__k")
    pos = (F.sum("__rows").over(group) - 1) * F.col("__q")
    start = F.sum("__rows").over(group.orderBy("__range")) - F.col("__rows")
    kept = (
        counts.withColumns({"__pos": pos, "__start": start})
        .where((F.col("__start") <= F.ceil("__pos")) & (F.col("__start") + F.col("__rows") > F.floor("__pos")))
        .select("__k", "__range", "__start", "__pos")
    )
    # Every column of the distinct values is used here as well, so that their shuffle is written once.
    inside = ranged.where("__p IS NOT NULL").join(kept, ["__k", "__range"])
    upto = F.sum("__w").over(W.partitionBy("__k", "__range").orderBy("__v"))
    placed = inside.withColumn("__last", F.col("__start") + upto - 1)

    def at(rank: Column) -> Column:
        held = (F.col("__last") - F.col("__w") < rank) & (F.col("__last") >= rank)
        return F.max(F.when(held, F.col("__v")))

    ends = placed.groupBy("__k").agg(
        at(F.floor("__pos")).alias("__low"), at(F.ceil("__pos")).alias("__high"), F.max("__pos").alias("__pos")
    )
    low, high = F.col("__low"), F.col("__high")
    between = low + (high - low) * (F.col("__pos") - F.floor("__pos"))
    return ends.select("__k.*", F.when(low == high, low).otherwise(between).alias(out))


def _range(value: Column, ranges: int) -> Column:
    """Number of a value's range: never falls where the value rises, and tells values of all sizes apart.

    It is never null, so that a join on it adds no filter to one reader of the values only.
    """
    scale = F.signum(value) * F.log1p(F.abs(value) * float(2**20))
    return F.when(F.isnan(value), F.lit(2**63 - 1)).otherwise(F.coalesce(F.floor(scale * ranges), F.lit(0)))
