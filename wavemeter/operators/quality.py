"""Reconciliation, repair, completeness and gaps."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wavemeter.functions.quantiles import exact_percentile
from wavemeter.functions.timeutil import business_day, ts_lit
from wavemeter.model import DIMENSIONS, MEASURES, TIME
from wavemeter.operators.joins import join_null_safe
from wavemeter.operators.predicates import usable_rate_row
from wavemeter.operators.recompute import known_buckets, rows_of_buckets
from wavemeter.operators.rollup import GRAINS, bucket, raw_rows, rollup_temporal


def reconcile(
    raw: DataFrame, rolled: DataFrame, grain: str, cadence: int | None = None, by_rate: bool = False
) -> DataFrame:
    """Buckets whose raw row count differs from the count kept in the roll-up.

    Raw rows are counted under the predicate of the roll-up itself; ``by_rate`` counts rows
    whose rate has a usable denominator instead. Both sides reduce to one row per bucket
    before the join.
    """
    if by_rate:
        counted = raw.where(
            (F.col("reportInterval") == (cadence or GRAINS[grain].raw_cadence)) & usable_rate_row()
        )
    else:
        source = grain if cadence is None else _level1(cadence)
        counted = raw_rows(raw, source)
    raw_counts = counted.groupBy(bucket(grain).alias(TIME)).agg(F.count(F.lit(1)).alias("raw_count"))
    kept = rolled.groupBy(bucket(grain).alias(TIME)).agg(F.sum("count").alias("rolled_count"))
    joined = raw_counts.join(kept, TIME, "full_outer").select(
        TIME,
        F.coalesce("raw_count", F.lit(0)).alias("raw_count"),
        F.coalesce("rolled_count", F.lit(0)).alias("rolled_count"),
    )
    return joined.where(F.col("raw_count") != F.col("rolled_count")).withColumn(
        "difference", F.abs(F.col("raw_count") - F.col("rolled_count"))
    )


# Sums may differ by the order in which doubles were added up.
SUM_TOLERANCE = 1e-9
# What a roll-up sets anew does not identify its facts.
IDENTITY = tuple(c for c in DIMENSIONS if c not in ("reportInterval", "granularityInterval"))


def _fingerprint(count: Column | str, part: Callable[[str, str], Column]) -> list[Column]:
    """Additive marks of a bucket: rows, rows weighted by a hash of their identity, and the measures."""
    rows = F.lit(1) if isinstance(count, Column) else F.col(count)
    marks = F.xxhash64(*IDENTITY).cast("decimal(38,0)") * rows
    return [
        F.sum(rows).alias("rows"),
        F.sum(marks.cast("decimal(38,0)")).alias("identity"),
        *[F.sum(part("sum", m)).alias(f"sum_{m}") for m in MEASURES],
        *[F.max(part("max", m)).alias(f"max_{m}") for m in MEASURES],
        *[F.min(part("min", m)).alias(f"min_{m}") for m in MEASURES],
    ]


def reconcile_content(raw: DataFrame, rolled: DataFrame, grain: str) -> DataFrame:
    """Buckets whose roll-up does not hold what its raw facts say, also where the counts agree.

    ``what`` is ``rows`` (counts differ), ``identity`` (other elements or metrics) or ``measures``
    (other values). Both sides reduce to one row per bucket before the join, by marks that add up
    in any order, so neither side is sorted and a hot bucket combines where it is read.
    """
    of_raw = raw_rows(raw, grain).groupBy(bucket(grain).alias(TIME)).agg(
        *_fingerprint(F.lit(1), lambda _, m: F.col(m))
    )
    of_rolled = rolled.groupBy(TIME).agg(*_fingerprint("count", lambda f, m: F.col(f"{f}_{m}")))
    a, b = of_raw.alias("a"), of_rolled.alias("b")

    def differ(column: str) -> Column:
        return ~F.col(f"a.{column}").eqNullSafe(F.col(f"b.{column}"))

    def far(column: str) -> Column:
        x, y = F.col(f"a.{column}"), F.col(f"b.{column}")
        size = F.greatest(F.abs(x), F.abs(y), F.lit(1.0))
        return F.coalesce(F.abs(x - y) > size * SUM_TOLERANCE, x.isNull() != y.isNull())

    ends = [differ(f"{f}_{m}") for f in ("max", "min") for m in MEASURES]
    measures = reduce(lambda x, y: x | y, [far(f"sum_{m}") for m in MEASURES] + ends)
    what = (
        F.when(differ("rows"), F.lit("rows"))
        .when(differ("identity"), F.lit("identity"))
        .when(measures, F.lit("measures"))
    )
    joined = a.join(b, F.col(f"a.{TIME}") == F.col(f"b.{TIME}"), "full_outer")
    return joined.select(
        F.coalesce(f"a.{TIME}", f"b.{TIME}").alias(TIME),
        F.coalesce("a.rows", F.lit(0)).alias("raw_count"),
        F.coalesce("b.rows", F.lit(0)).alias("rolled_count"),
        what.alias("what"),
    ).where("what IS NOT NULL")


def _level1(cadence: int) -> str:
    return next(g for g, spec in GRAINS.items() if spec.raw_cadence == cadence)


def repair(
    raw: DataFrame,
    rolled: DataFrame,
    grain: str,
    rebuild: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """The roll-up with every differing bucket recomputed; all buckets in one job.

    The differing buckets are found once; raw facts outside their time range are not read.
    """
    damaged = known_buckets(reconcile(raw, rolled, grain))
    rows = rows_of_buckets(raw, damaged, grain)
    fresh = (rebuild or (lambda df: rollup_temporal(df, grain)))(rows)
    return rolled.join(damaged, TIME, "left_anti").unionByName(fresh)


def damaged_days(differences: DataFrame) -> DataFrame:
    """Business days to rebuild after their buckets were repaired."""
    return differences.select(business_day(F.col(TIME)).alias("day")).distinct()


def missing_sources(
    listing: DataFrame, facts: DataFrame, run_day: datetime, days_back: int = 4,
    name: str = "managerFilename",
) -> DataFrame:
    """Listed sources no fact of ``[run_day - days_back, run_day)`` names."""
    start = run_day - timedelta(days=days_back)
    loaded = (
        facts.where((F.col(TIME) >= ts_lit(start)) & (F.col(TIME) < ts_lit(run_day)))
        .select(F.col(name).alias("__name"))
        .distinct()
    )
    return listing.join(loaded, listing[name] == loaded["__name"], "left_anti")


def compaction_candidates(
    df: DataFrame, chunk: Column, limit: int, start: datetime, end: datetime
) -> DataFrame:
    """Time chunks of ``[start, end)`` that hold fewer than ``limit`` rows."""
    return (
        df.where((F.col(TIME) >= ts_lit(start)) & (F.col(TIME) < ts_lit(end)))
        .groupBy(chunk.alias("chunk"))
        .agg(F.count(F.lit(1)).alias("rows"))
        .where(F.col("rows") < limit)
    )


def candidate_range(candidates: DataFrame) -> DataFrame:
    """First and last day among the candidates, one row."""
    return candidates.agg(
        F.to_date(F.min("chunk")).alias("first_day"),
        F.to_date(F.max("chunk")).alias("last_day"),
        F.count(F.lit(1)).alias("chunks"),
    )


SCOPE = ("kpi_id", "managedobject_id", "granularityinterval", "aggregation_time")


def completeness(
    counts: DataFrame, history: DataFrame, percent: float, scope: Sequence[str] = SCOPE
) -> DataFrame:
    """Gate decision per scope.

    A scope loads when it has rows and reaches ``percent`` of the median of its past record
    counts (half-even rounding); a scope without history needs one row. Otherwise it is
    partial once the waiting time is over. A scope with history but no row now counts 0.
    """
    scope = list(scope)
    known = history.select(*scope).distinct()
    counts = (
        join_null_safe(known.unionByName(counts.select(*scope)).distinct(), counts, scope, "left")
        .withColumn("records", F.coalesce("records", F.lit(0)))
        .select(*scope, "records")
    )
    median = exact_percentile(history, scope, "records", 0.5, "median")
    needed = F.bround(F.coalesce("median", F.lit(0.0)) * F.lit(percent / 100.0), 0).cast("long")
    gated = join_null_safe(counts, median, scope, "left").withColumn("acceptable", needed)
    enough = (F.col("records") >= F.col("acceptable")) & (F.col("records") > 0)
    return gated.select(
        *scope,
        "records",
        "acceptable",
        F.when(enough, "LOAD").otherwise("PARTIAL").alias("status"),
        F.when(enough, "Completed").otherwise("Partial").alias("load_status"),
    )
