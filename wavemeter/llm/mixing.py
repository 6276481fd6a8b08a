"""Mixing sources to target weights over a tree, as DataFrame operations only."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wavemeter.llm.expressions import stored, text_of, word_count

BROADCAST_LEAVES = 10_000


@dataclass(frozen=True)
class Mix:
    """Whole-number weights by path of names from the root; a path not listed weighs 1, 0 drops it.

    ``share`` of all tokens is the budget; a leaf is repeated ``epochs`` times at most.
    """

    weights: Mapping[tuple[str, ...], int] = field(default_factory=dict)
    share: tuple[int, int] = (1, 2)
    epochs: int = 1
    seed: str = "0"


def _weight(levels: Sequence[str], weights: Mapping[tuple[str, ...], int]) -> Column:
    listed = {"\0".join(path): int(w) for path, w in weights.items() if len(path) == len(levels)}
    if not listed:
        return F.lit(1).cast("long")
    table = F.create_map(*(F.lit(x) for pair in listed.items() for x in pair))
    return F.coalesce(F.try_element_at(table, F.concat_ws("\0", *levels)), F.lit(1)).cast("long")


def _fill(nodes: DataFrame, parents: list[str], name: str) -> DataFrame:
    """Share the parents' budget among children by weight; none gets more than its capacity.

    Children by capacity for each unit of weight: as long as the next one's share of what is left
    exceeds its capacity it is full, and its shortage stays with its siblings. The first that is
    not full and all behind it share the rest by weight, rounded down.
    """
    group = Window.partitionBy(*parents)
    order = group.orderBy(F.col("capacity") / F.col("weight"), F.col(name))
    ahead = order.rowsBetween(Window.unboundedPreceding, -1)
    measured = nodes.withColumns(
        {
            "left": F.col("budget") - F.coalesce(F.sum("capacity").over(ahead), F.lit(0)),
            "weights_left": F.sum("weight").over(group) - F.coalesce(F.sum("weight").over(ahead), F.lit(0)),
        }
    ).withColumn(
        "open", F.col("left") * F.col("weight") < F.col("capacity") * F.col("weights_left")
    )
    first = F.min(F.when(F.col("open"), F.struct(F.col("capacity") / F.col("weight"), F.col(name), "left", "weights_left"))).over(group)
    return measured.withColumn("rest", first).withColumn(
        "budget",
        F.when(
            F.col("open"), F.expr("(rest.left * weight) div rest.weights_left")
        ).otherwise(F.col("capacity")),
    ).drop("rest", "open", "left", "weights_left")


def leaf_budgets(rows: DataFrame, levels: list[str], tokens: str, mix: Mix) -> DataFrame:
    """Budget of every leaf: (levels, available, budget).

    Capacities are summed up the tree, budgets handed down it. A parent never gets more than its
    children can use, so shortages go to siblings first and to the ancestors' siblings after that.
    """
    weighted = rows.groupBy(*levels).agg(F.sum(tokens).alias("available"))
    product = F.lit(True)
    for depth in range(1, len(levels) + 1):
        product = product & (_weight(levels[:depth], mix.weights) > 0)
    leaves = stored(
        weighted.withColumn(
            "capacity", F.when(product, F.col("available") * mix.epochs).otherwise(F.lit(0)).cast("long")
        ),
        "mixing-leaves",
    )
    # Two numbers for any input.
    sums = leaves.agg(F.sum("available").alias("available"), F.sum("capacity").alias("capacity")).first()
    share, of = mix.share
    budget = min((sums["available"] or 0) * share // of, sums["capacity"] or 0)
    leaves = leaves.withColumn("root", F.lit(0))
    above: list[str] = []
    budgets = None
    for depth, name in enumerate(levels, 1):
        nodes = (
            leaves.groupBy("root", *levels[:depth])
            .agg(F.sum("capacity").alias("capacity"), F.sum("available").alias("available"))
            .withColumn("weight", _weight(levels[:depth], mix.weights))
            .filter("weight > 0")
        )
        nodes = nodes.join(budgets, above) if depth > 1 else nodes.withColumn("budget", F.lit(budget).cast("long"))
        above = ["root", *levels[:depth]]
        budgets = _fill(nodes, above[:-1], name).select(*above, "budget", "available")
        if depth < len(levels):
            budgets = budgets.drop("available")
    return budgets.drop("root")


def mix_sources(
    docs: DataFrame,
    levels: Mapping[str, Column],
    tokens: Column,
    mix: Mix,
    key: str = "doc_id",
    keep: Sequence[str] = (),
) -> DataFrame:
    """The rows selected: key, level names, ``epoch``, ``n_tokens``, ``budget``, then ``keep``.

    A leaf's budget buys whole epochs first and then a prefix of the next. The order of an epoch is
    that of the MD5 of (seed, epoch, key); the prefix ends before the first document with tokens
    that would pass the budget. Null level names are the empty name, null tokens 0, null keys the
    empty key. A kept column takes the place of one of its name. Repeated rows count each and stand side by side; documents without tokens cost
    nothing. An empty table or budget selects nothing. Extra columns are ignored unless kept.

    The running sum of a leaf is split over the first three digits of the MD5, so a leaf with a
    third of all rows is summed in 4,096 parts whose totals, a row each, give the starts.
    """
    names = [*levels]
    rows = docs.select(
        docs[key].alias("_key"),
        *(text_of(column).alias(f"_l{i}") for i, column in enumerate(levels.values())),
        F.coalesce(tokens, F.lit(0)).cast("long").alias("_tokens"),
        *(docs[c].alias(f"_c{i}") for i, c in enumerate(keep)),
    )
    inner = [f"_l{i}" for i in range(len(names))]
    # Tokens are counted once for the sums; columns to keep are not written twice for it.
    slim = stored(rows.select("_key", *inner, "_tokens"), "mixing-rows")
    rows = rows if keep else slim
    leaves = stored(leaf_budgets(slim, inner, "_tokens", mix), "mixing-budgets")
    if leaves.count() <= BROADCAST_LEAVES:
        leaves = F.broadcast(leaves)
    order = F.md5(F.concat_ws(":", F.lit(mix.seed), F.col("_full"), F.coalesce(F.col("_key").cast("string"), F.lit(""))))

    def ordered(some: DataFrame) -> DataFrame:
        bought = some.join(leaves, inner).withColumns(
            {
                "_full": F.expr("if(available > 0, budget div available, 0)"),
                "_rest": F.expr("if(available > 0, budget % available, 0)"),
            }
        )
        return bought.withColumn("_order", order).withColumn("_part", F.substring("_order", 1, 3))

    by_part = Window.partitionBy(*inner, "_part")
    upto = by_part.orderBy("_order", "_tokens").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    part_totals = (
        ordered(slim).groupBy(*inner, "_part").agg(F.sum("_tokens").alias("_amount"))
        .withColumn(
            "_ahead",
            F.coalesce(
                F.sum("_amount").over(
                    Window.partitionBy(*inner).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
                ),
                F.lit(0),
            ),
        )
        .select(*inner, "_part", "_ahead")
    )
    summed = ordered(rows).withColumn("_within", F.sum("_tokens").over(upto)).join(part_totals, [*inner, "_part"])
    epochs = F.when(
        (F.col("_rest") > 0) & (F.col("_ahead") + F.col("_within") <= F.col("_rest")), F.col("_full") + 1
    ).otherwise(F.col("_full"))
    own = {
        key: F.col("_key").alias(key),
        **{n: F.col(i).alias(n) for i, n in zip(inner, names, strict=True)},
        "epoch": F.col("_epoch").cast("int").alias("epoch"),
        "n_tokens": F.col("_tokens").alias("n_tokens"),
        "budget": F.col("budget"),
    }
    return (
        summed.withColumn("_epochs", epochs.cast("int"))
        .filter("_epochs > 0")
        .withColumn("_epoch", F.explode(F.sequence(F.lit(0), F.col("_epochs") - 1)))
        .select(
            *(column for name, column in own.items() if name not in keep),
            *(F.col(f"_c{i}").alias(c) for i, c in enumerate(keep)),
        )
    )


def source_domain(source: Column) -> Column:
    """The domain a numbered source belongs to: its number modulo four; the rest are 'other'."""
    number = F.regexp_extract(text_of(source), "^src([0-9]{1,9})$", 1)
    domains = F.array(*map(F.lit, ("web", "news", "books", "talk")))
    return F.when(number == "", F.lit("other")).otherwise(
        F.get(domains, (number.cast("long") % 4).cast("int"))
    )


# The production mix: weights of domains, of languages within two of them, and of one source.
PRODUCTION = Mix(
    weights={
        ("web",): 3,
        ("news",): 2,
        ("books",): 4,
        ("talk",): 1,
        ("web", "en"): 3,
        ("web", "de"): 2,
        ("books", "en"): 2,
        ("web", "en", "src0"): 2,
    },
    share=(1, 2),
    epochs=2,
    seed="mix-1",
)


def op10_source_mix(spark, sf_dir: str, mix: Mix = PRODUCTION) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    levels = {"domain": source_domain(docs.source), "lang": docs.lang, "source": docs.source}
    return mix_sources(docs, levels, word_count(text_of(docs.text)), mix)
