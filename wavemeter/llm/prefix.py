"""Running sums over all rows without a task that sees them all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def value_blocks(df: DataFrame, column: str, blocks: int) -> Column:
    """Number of the block of near-equal row counts that a value lies in, by ascending value.

    The cuts come from one approximate-percentile job: ``blocks`` numbers, whatever the input.
    They are literals from then on, so every retry gives the same blocks. Two short scans
    of the cuts find a block. Nulls are in block 0.
    """
    shares = [i / blocks for i in range(1, blocks)]
    if not shares:
        return F.lit(0)
    found = df.agg(F.percentile_approx(column, shares, max(10_000, 4 * blocks)).alias("cuts")).first()["cuts"]
    cuts = sorted(set(found or []))
    if not cuts:
        return F.lit(0)
    step = max(1, int(len(cuts) ** 0.5))
    all_cuts, coarse = F.array(*map(F.lit, cuts)), F.array(*map(F.lit, cuts[step - 1 :: step]))
    value = F.col(column)
    first = F.size(F.filter(coarse, lambda c: c < value)) * step
    within = F.slice(all_cuts, F.lit(1), F.lit(len(cuts)))
    return F.when(value.isNull(), F.lit(0)).otherwise(
        F.transform(
            F.array(first),
            lambda f: f + F.size(F.filter(F.slice(within, f + 1, F.lit(step)), lambda c: c < value)),
        )[0]
    )


def running_sums(df: DataFrame, group: list[str], block: str, order: list[str], amount: str) -> DataFrame:
    """Add ``before`` (sum of amounts ahead), ``place`` (rows ahead), ``total`` and ``rows``.

    Rows of a group are ordered by block, then by ``order``. Each block is summed on its own; the
    totals of the blocks, one row each, then give every block its start.
    """
    ahead = Window.partitionBy(*group).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*group)
    totals = (
        df.groupBy(*group, block)
        .agg(F.sum(amount).alias("_amount"), F.count(F.lit(1)).alias("_rows"))
        .withColumns(
            {
                "_amount_ahead": F.coalesce(F.sum("_amount").over(ahead), F.lit(0)),
                "_rows_ahead": F.coalesce(F.sum("_rows").over(ahead), F.lit(0)),
                "total": F.sum("_amount").over(whole),
                "rows": F.sum("_rows").over(whole),
            }
        )
        .select(
            *(F.col(c).alias(f"_k{i}") for i, c in enumerate([*group, block])),
            "_amount_ahead", "_rows_ahead", "total", "rows",
        )
    )
    within = Window.partitionBy(*group, block).orderBy(*order)
    upto = within.rowsBetween(Window.unboundedPreceding, -1)
    summed = df.withColumns(
        {
            "_within": F.coalesce(F.sum(amount).over(upto), F.lit(0)),
            "_at": F.row_number().over(within) - 1,
        }
    )
    keys = [F.col(c).eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate([*group, block])]
    condition = keys[0]
    for key in keys[1:]:
        condition = condition & key
    return summed.join(totals, condition).select(
        *df.columns,
        (F.col("_within") + F.col("_amount_ahead")).alias("before"),
        (F.col("_at") + F.col("_rows_ahead")).alias("place"),
        "total",
        "rows",
    )
