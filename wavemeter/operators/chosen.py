"""Aggregation whose function is a column value, as configs name it."""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wavemeter.functions.quantiles import weighted_percentile

PLAIN = ("SUM", "AVG", "MAX", "MIN", "COUNT")
PERCENTILE = "PERCENTILE"


def aggregate_by_name(
    rows: DataFrame,
    keys: Sequence[str],
    function: str,
    percentile: str,
    value: str,
    out: str,
    rate: tuple[str, str, str] | None = None,
    functions: Collection[str] | None = None,
    sums: Collection[str] = (),
) -> DataFrame:
    """``(keys, records, out, sums)``; every group uses the function named in its rows.

    One combinable aggregation answers all groups. Groups that ask for a percentile keep their
    distinct values apart in it; these are answered in the same plan by ranges of values, so that no
    task gathers a group. ``functions`` names the functions that occur; without ``PERCENTILE``
    among them the plan has one shuffle.

    ``function`` and ``percentile`` (0 to 100) are constant within a group. ``rate`` names
    the flag, numerator and denominator: sums and averages of a rate are the ratio of the
    summed parts, and the plain result where that has no value. ``sums`` are columns to add up.
    """
    keys = list(keys)
    named = rows.where(F.col(value).isNotNull()).withColumn("__f", F.upper(F.col(function)))
    known = named.where(F.col("__f").isin(*PLAIN, PERCENTILE))
    flag, num, den = rate or (None, None, None)
    added = {"__sum": value, **{c: c for c in sums}} | ({"__num": num, "__den": den} if rate else {})
    first = [
        F.count(value).alias("records"), F.max(value).alias("__max"), F.min(value).alias("__min"),
        *[F.sum(c).alias(n) for n, c in added.items()],
    ]
    merged = [
        F.sum("records").alias("records"), F.max("__max").alias("__max"), F.min("__min").alias("__min"),
        *[F.sum(n).alias(n) for n in added],
    ]
    if rate:
        first.append(F.max(flag).alias("__rate"))
        merged.append(F.max("__rate").alias("__rate"))
    by_name = {
        "SUM": F.col("__sum"), "AVG": F.col("__sum") / F.col("records"), "MAX": F.col("__max"),
        "MIN": F.col("__min"), "COUNT": F.col("records").cast("double"),
    }
    choice = F.coalesce(*[F.when(F.col("__f") == f, by_name[f]) for f in PLAIN])
    if rate:
        ratio = F.when(
            F.col("__rate") & F.col("__f").isin("SUM", "AVG") & (F.col("__den") != 0),
            F.col("__num") / F.col("__den"),
        )
        choice = F.coalesce(ratio, choice)
    if functions is not None and PERCENTILE not in functions:
        return known.groupBy(*keys, "__f").agg(*first).select(*keys, "records", choice.alias(out), *sums)

    asked = F.col("__f") == PERCENTILE
    base = known.withColumns(
        {"__v": F.when(asked, F.col(value).cast("double")), "__p": F.when(asked, F.col(percentile) / 100.0)}
    ).groupBy(*keys, "__f", "__v").agg(*first, F.max("__p").alias("__p"))
    # True of every row, as values are never null. It names all columns and can not be moved below the
    # aggregation, so that all readers of ``base`` share one shuffle instead of pruned ones of their own.
    named_all = F.concat_ws("", *[F.col(c).cast("string") for c in base.columns])
    base = base.where(F.col("__max").isNotNull() | (named_all == ""))
    totals = base.groupBy(*keys, "__f").agg(*merged)
    values = base.where("__p IS NOT NULL").select(*keys, "__v", F.col("records").alias("__w"), "__p")
    exact = weighted_percentile(values, keys, "__exact")
    exact = exact.select(F.struct(*keys).alias("__k"), "__exact")
    return totals.withColumn("__k", F.struct(*keys)).join(exact, "__k", "left").select(
        *keys, "records", F.coalesce("__exact", choice).alias(out), *sums
    )
