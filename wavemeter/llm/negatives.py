"""Hard negatives: the threshold algorithm over sorted lists of every dimension."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wavemeter.llm.expressions import ship_code, stored


@dataclass(frozen=True)
class Mining:
    """``every``: anchors are the rows whose id it divides. ``low`` and ``high``: a negative's score lies
    between these shares (numerator, denominator) of the positive's."""

    every: int = 50
    positives: int = 5
    negatives: int = 3
    low: tuple[int, int] = (50, 100)
    high: tuple[int, int] = (95, 100)
    # Candidates whose lists one task holds, and anchors that are put to them at a time.
    block_rows: int = 4096
    block_anchors: int = 65_536


# Whole numbers up to this size are exact in double precision.
EXACT = 2.0**53
LARGEST, LEAST = 2**63 - 1, -(2**63)
# Places of every list that are read at first; doubled until the threshold stops the search.
FIRST_DEPTH = 64


def usable(vector: Column) -> Column:
    """Not null, and all components there and finite."""
    return vector.isNotNull() & F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    )


def quantised(vectors: np.ndarray) -> np.ndarray:
    """floor(256 * x): whole doubles, or Python's integers where doubles would not be exact."""
    if np.abs(vectors).max(initial=0) < EXACT / 256:
        return np.floor(256 * vectors)
    whole = [[int(np.floor(256 * x)) if abs(x) < EXACT / 256 else 256 * int(x) for x in row] for row in vectors]
    return np.array(whole, object).reshape(vectors.shape)


def _integers(matrix: np.ndarray) -> np.ndarray:
    if matrix.dtype == object:
        return matrix
    return np.array([int(v) for v in matrix.ravel()] or [], object).reshape(matrix.shape)


def _widened(matrix: np.ndarray, width: int) -> np.ndarray:
    """Zeros behind the components that are there."""
    return np.pad(matrix, [(0, 0)] * (matrix.ndim - 1) + [(0, width - matrix.shape[-1])])


class Lists:
    """Candidates with one list for each dimension, sorted by component."""

    def __init__(self, ids: Sequence[int], tags: Sequence[int], labels: Sequence[str], vectors: Sequence[np.ndarray]):
        width = max(map(len, vectors))
        self.ids, self.tags = np.array(ids, np.int64), np.array(tags, np.int64)
        numbers: dict[str, int] = {}
        self.labels = np.array([numbers.setdefault(x, len(numbers)) for x in labels], np.int32)
        self.numbers = numbers
        # Components are quantised one by one, so the zeros behind short vectors stay zeros.
        self.rows = quantised(np.stack([_widened(v, width) for v in vectors]))
        self.order = np.ascontiguousarray(np.argsort(self.rows, axis=0, kind="stable").T)
        self.sorted = np.take_along_axis(self.rows.T, self.order, axis=1)
        self.greatest = max((abs(int(v)) for v in (self.rows.max(initial=0), self.rows.min(initial=0))), default=0)

    def first(
        self, anchor: np.ndarray, allowed: np.ndarray, windows: Sequence[tuple[int | None, int | None]], k: int
    ) -> list[list[tuple[int, int]]]:
        """For each window the first ``k`` allowed rows (score, place) with a score in it, by score, then id.

        Every list is read from the end that the sign of the anchor's component favours. Rows are
        scored when they are first met. What a row not yet met can score at most is the sum over the
        lists of the anchor's component times the last one read; once that lies strictly below a
        window's kth score, or below the window, the window is done.
        """
        n, width = self.rows.shape
        anchor = _widened(anchor, max(width, len(anchor)))[:width]
        rows, values = self.rows, self.sorted
        bound = self.greatest * max((abs(int(a)) for a in anchor), default=0) * max(width, 1)
        if rows.dtype == object or anchor.dtype == object or bound >= EXACT:
            rows, values, anchor = _integers(rows), _integers(values), _integers(anchor)
        up, down = np.flatnonzero(anchor > 0), np.flatnonzero(anchor < 0)
        met, scored = np.zeros(n, bool), ~allowed
        held: list[list[tuple[int, int]]] = [[] for _ in windows]
        start, stop = 0, FIRST_DEPTH
        while True:
            # Without a component that counts there is no list to read, and all scores are 0.
            stop = n if not len(up) + len(down) else min(n, stop)
            if len(up) + len(down):
                met[self.order[up, n - stop : n - start]] = True
                met[self.order[down, start:stop]] = True
            else:
                met[:] = True
            new = np.flatnonzero(met & ~scored)
            scored[new] = True
            scores = rows[new] @ anchor if width else np.zeros(len(new))
            most = anchor[up] @ values[up, n - stop] + anchor[down] @ values[down, stop - 1] if stop < n else None
            if anchor.dtype == object:
                scores, most = np.clip(scores, LEAST, LARGEST), most if most is None else min(max(most, LEAST), LARGEST)
            done = stop == n
            open_windows = 0
            for w, (low, high) in enumerate(windows):
                inside = np.ones(len(new), bool)
                if low is not None:
                    inside &= scores >= low
                if high is not None:
                    inside &= scores <= high
                places = new[inside]
                if len(places):
                    there = scores[inside]
                    if len(there) > 4 * k:
                        worst = np.partition(-there, k - 1)[k - 1]
                        places, there = places[-there <= worst], there[-there <= worst]
                    both = held[w] + [(int(s), p) for s, p in zip(there.tolist(), places.tolist(), strict=True)]
                    held[w] = sorted(both, key=lambda x: (-x[0], self.ids[x[1]], self.tags[x[1]]))[:k]
                if not done:
                    below = low is not None and most < low
                    open_windows += not (below or (len(held[w]) == k and most < held[w][-1][0]))
            if done or not open_windows:
                return held
            start, stop = stop, 2 * stop


def _answers(own_label: bool, k: int):
    """Task code: candidates of a group come first, its anchors after them."""

    def run(batches):
        group, lists = None, None
        held: list[tuple] = []
        for batch in batches:
            columns = [batch[c].to_pylist() for c in ("grp", "side", "id", "tag", "label")]
            offsets = batch["vector"].offsets.to_numpy()
            flat = batch["vector"].values.to_numpy(zero_copy_only=False)
            asked = batch["windows"].to_pylist()
            out = []
            for i, (at, side, row, tag, label) in enumerate(zip(*columns, strict=True)):
                vector = flat[offsets[i] : offsets[i + 1]]
                if at != group:
                    group, lists, held = at, None, []
                if side == 0:
                    held.append((row, tag, label, vector.copy()))
                    continue
                if lists is None:
                    if not held:
                        continue
                    lists = Lists(*zip(*held, strict=True))
                    held = held[:1]
                same = lists.labels == lists.numbers.get(label, -1)
                if own_label:
                    allowed, windows = same & (lists.ids != row), [(None, None)]
                else:
                    allowed, windows = ~same, [(w["low"], w["high"]) for w in asked[i]]
                if not allowed.any():
                    continue
                found = lists.first(quantised(vector[None])[0], allowed, windows, k)
                out += [
                    (row, tag, n, int(lists.ids[p]), int(lists.tags[p]), score)
                    for n, hits in enumerate(found)
                    for score, p in hits
                ]
            columns = list(zip(*out, strict=True)) or [()] * 6
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                names=["anchor", "anchor_tag", "nth", "id", "tag", "score"],
            )

    return run


_FOUND = "anchor long, anchor_tag long, nth int, id long, tag long, score long"
_WINDOWS = "array<struct<low:long,high:long>>"


def _asked(rows: DataFrame, anchors: DataFrame, blocks: int, parts: int, own_label: bool, k: int) -> DataFrame:
    """The first ``k`` of every block for every anchor: candidates and anchors meet block by block."""
    # For its own label an anchor meets only the part of a block that has it. Labels are compared
    # again in the task, so two labels with the same hash do no harm.
    spot = (F.xxhash64("label", "block"),) if own_label else ("block",)
    part = F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    there = rows.select("block", "id", "tag", "label", "vector", part.alias("part")).withColumn("side", F.lit(0))
    there = there.withColumn("windows", F.lit(None).cast(_WINDOWS))
    here = anchors.select(
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"),
        "id", "tag", "label", "vector", "windows",
        F.pmod(F.xxhash64("tag"), F.lit(parts)).cast("int").alias("part"),
        F.lit(1).alias("side"),
    )
    met = there.unionByName(here).withColumn("grp", F.xxhash64(*spot, "part") if own_label else F.col("block") * parts + F.col("part"))
    return (
        met.repartition(max(2, blocks * parts), "grp")
        .sortWithinPartitions("grp", "side")
        .select("grp", "side", "id", "tag", "label", "vector", "windows")
        .mapInArrow(_answers(own_label, k), _FOUND)
    )


def _best(found: DataFrame, k: int, *by: str) -> DataFrame:
    """The first ``k`` over all blocks, with their place."""
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "id", "tag")
    return found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)


def _share(score: Column, share: tuple[int, int], up: bool) -> Column:
    """Least (``up``) or greatest whole number that is at least or at most this share of a score."""
    exact = score.cast("decimal(30,0)") * share[0] / F.lit(share[1]).cast("decimal(10,0)")
    return (F.ceil(exact) if up else F.floor(exact)).cast("long")


def hard_negatives(
    vectors: DataFrame, mining: Mining = Mining(), key: str = "vec_id", vector: str = "embedding", label: str = "label"
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``.

    Components become floor(256 * x); the score of a row is its integer inner product with the anchor;
    higher scores come first, equal ones by smaller id. An anchor's positives are the first other rows
    of its label, and each gets the first rows of other labels whose scores lie in its window.

    Rows with a null id, label or vector, or with null or non-finite components, take no part. Rows
    equal in id, label and vector count once; rows that share only the id each count, and none is
    its namesake's positive. Components beyond the end of a shorter vector count as 0. Scores are exact
    up to 64 bits; the ends of that range stand for those beyond it. An anchor without positives, or a positive
    without negatives, gives no rows, nor does an empty table; other columns are ignored.

    Candidates are dealt by hash into blocks of a fixed size, so no label and no vector makes a block
    large. Each block meets all anchors in turn, and its first few go on to be ranked.
    """
    ship_code(vectors.sparkSession)
    clean = vectors.select(
        vectors[key].cast("long").alias("id"),
        vectors[label].cast("string").alias("label"),
        vectors[vector].cast("array<double>").alias("vector"),
    ).filter(F.col("id").isNotNull() & F.col("label").isNotNull() & usable(F.col("vector")))
    once = stored(
        clean.dropDuplicates(["id", "label", "vector"]).withColumn("tag", F.xxhash64("id", "label", "vector")),
        "negatives-rows",
    )
    anchors = once.filter(F.col("id") % mining.every == 0)
    blocks = max(1, ceil(once.count() / mining.block_rows))
    parts = max(1, ceil(anchors.count() / mining.block_anchors))
    rows = once.withColumn("block", F.pmod(F.xxhash64("tag"), F.lit(blocks)).cast("long"))
    open_asks = anchors.withColumn("windows", F.lit(None).cast(_WINDOWS))
    positives = stored(
        _best(_asked(rows, open_asks, blocks, parts, True, mining.positives), mining.positives, "anchor", "anchor_tag").select(
            "anchor", "anchor_tag", "place", "id", "score",
            _share(F.col("score"), mining.low, True).alias("low"),
            _share(F.col("score"), mining.high, False).alias("high"),
        ),
        "negatives-positives",
    )
    listed = positives.groupBy("anchor", "anchor_tag").agg(
        F.transform(
            F.sort_array(F.collect_list(F.struct("place", "low", "high"))), lambda p: F.struct(p["low"].alias("low"), p["high"].alias("high"))
        ).alias("windows")
    )
    asks = anchors.join(listed, (F.col("id") == F.col("anchor")) & (F.col("tag") == F.col("anchor_tag"))).select(
        "id", "tag", "label", "vector", "windows"
    )
    found = _asked(rows, stored(asks, "negatives-asks"), blocks, parts, False, mining.negatives)
    negatives = _best(found, mining.negatives, "anchor", "anchor_tag", "nth").select(
        F.col("anchor").alias("a"), F.col("anchor_tag").alias("t"), "nth", F.col("place").alias("rank"),
        F.col("id").alias("negative_id"), F.col("score").alias("negative_score"),
    )
    same = (F.col("a") == F.col("anchor")) & (F.col("t") == F.col("anchor_tag")) & (F.col("nth") + 1 == F.col("place"))
    return positives.join(negatives, same).select(
        F.col("anchor").alias("anchor_id"),
        F.col("id").alias("positive_id"),
        F.col("rank").cast("int").alias("rank"),
        "negative_id",
        F.col("score").alias("positive_score"),
        "negative_score",
    )


def op13_hard_negatives(spark, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(vectors.withColumn("label", moved))
