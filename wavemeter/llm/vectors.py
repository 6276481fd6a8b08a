"""Near-duplicate vectors by tiles in the order of their principal components."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType, StructType

from wavemeter.llm.components import components
from wavemeter.llm.expressions import ship_code, stored


@dataclass(frozen=True)
class Tiles:
    """``threshold`` is of the cosine. ``tile`` vectors are meant to stand in one tile; ``leading``
    components bound tiles against each other, ``components`` pairs. ``sample`` vectors by hash fit
    the components: any rotation gives the same result, a fitted one earlier stops. ``cuts`` is the
    most tiles of a label; tiles of larger labels hold more vectors and are worked in blocks."""

    threshold: float = 0.93
    tile: int = 1024
    leading: int = 8
    components: int = 64
    sample: int = 4096
    cuts: int = 1024
    block: int = 64


# Rounding of sums of products of unit vectors stays far below this.
SLACK = 1e-9


def usable(vector: Column) -> Column:
    """Whether a vector is neither null nor zero and holds finite numbers alone."""
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf"))
    )
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt(np.einsum("ij,ij->i", scaled, scaled))[:, None]


def _bases(classes: DataFrame, rows: int, tiles: Tiles) -> dict[int, np.ndarray]:
    """Leading principal components by length of vector, from a sample of bounded size."""
    step = max(1, rows // tiles.sample)
    sampled = classes.filter(F.pmod(F.xxhash64("vector"), F.lit(step)) == 0).select("vector").toArrow()
    by_length: dict[int, list] = {}
    for vector in sampled["vector"].to_pylist():
        by_length.setdefault(len(vector), []).append(vector)
    out = {}
    for length, vectors in by_length.items():
        unit = _unit(np.array(vectors, np.float64))
        _, axes = np.linalg.eigh(unit.T @ unit)
        out[length] = np.ascontiguousarray(axes[:, ::-1][:, : tiles.components])
    return out


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Vectors of one length as rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = np.asarray(column.flatten(), np.float64)
    return flat.reshape(len(column), -1)


def _projected(unit: np.ndarray, bases: dict[int, np.ndarray], tiles: Tiles) -> np.ndarray:
    axes = bases.get(unit.shape[1])
    return unit[:, : tiles.components] if axes is None else unit @ axes


def _rest(projected: np.ndarray, upto: int) -> np.ndarray:
    """Norm of what lies beyond the first components of a unit vector."""
    lead = projected[:, :upto]
    return np.sqrt(np.maximum(0.0, 1.0 - np.einsum("ij,ij->i", lead, lead)))


def _led(classes: DataFrame, bases: dict[int, np.ndarray], tiles: Tiles) -> DataFrame:
    """Add ``lead`` (first components, zeros beyond the length) and ``rest`` to every class."""

    def run(batches):
        for batch in batches:
            column = batch.column("vector")
            lengths = np.diff(np.asarray(column.offsets))
            lead, rest = np.zeros((len(lengths), tiles.leading)), np.zeros(len(lengths))
            for length in np.unique(lengths):
                at = np.flatnonzero(lengths == length)
                projected = _projected(_unit(_matrix(column.take(pa.array(at)))), bases, tiles)
                width = min(tiles.leading, projected.shape[1])
                lead[at, :width], rest[at] = projected[:, :width], _rest(projected, tiles.leading)
            values = pa.FixedSizeListArray.from_arrays(pa.array(lead.ravel()), tiles.leading).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*batch.columns, values, pa.array(rest)], names=[*batch.schema.names, "lead", "rest"])

    schema = StructType([*classes.schema.fields]).add("lead", ArrayType(DoubleType())).add("rest", DoubleType())
    return classes.mapInArrow(run, schema)


def _tiled(led: DataFrame, tiles: Tiles) -> DataFrame:
    """Add the tile of every class within its label and length, by first component."""
    shares = [i / tiles.cuts for i in range(1, tiles.cuts)]
    spread = led.groupBy("label", "length").agg(
        F.count(F.lit(1)).alias("held"),
        F.percentile_approx(F.col("lead")[0], shares, 10 * tiles.cuts).alias("points"),
    )
    wanted = F.least(F.lit(tiles.cuts), F.ceil(F.col("held") / tiles.tile)).cast("int")
    cuts = spread.withColumn("wanted", wanted).select(
        "label",
        "length",
        F.when(F.col("wanted") < 2, F.array().cast("array<double>"))
        .otherwise(
            F.transform(
                F.sequence(F.lit(1), F.greatest(F.col("wanted") - 1, F.lit(1))),
                lambda i: F.get("points", F.floor(i * tiles.cuts / F.col("wanted")).cast("int") - 1),
            )
        )
        .alias("cuts"),
    )
    first = F.col("lead")[0]
    return led.join(cuts, ["label", "length"]).withColumn("tile", F.size(F.filter("cuts", lambda c: c < first))).drop("cuts")


def _tile_pairs(tiled: DataFrame, tiles: Tiles) -> DataFrame:
    """Pairs of tiles (label, length, i, j), i <= j, whose boxes allow the threshold."""
    lead = [F.col("lead")[k] for k in range(tiles.leading)]
    boxes = tiled.groupBy("label", "length", "tile").agg(
        F.array(*(F.min(c) for c in lead)).alias("low"),
        F.array(*(F.max(c) for c in lead)).alias("high"),
        F.max("rest").alias("rest"),
    )

    def side(mark: str) -> DataFrame:
        return boxes.select("label", "length", *(F.col(c).alias(f"{c}_{mark}") for c in ("tile", "low", "high", "rest")))

    reach = F.col("rest_i") * F.col("rest_j")
    for k in range(tiles.leading):
        ends = [F.col(f"{a}_i")[k] * F.col(f"{b}_j")[k] for a in ("low", "high") for b in ("low", "high")]
        reach = reach + F.greatest(*ends)
    return (
        side("i").join(side("j"), ["label", "length"])
        .filter("tile_i <= tile_j").filter(reach >= tiles.threshold - SLACK)
        .select("label", "length", F.col("tile_i").alias("i"), F.col("tile_j").alias("j"))
    )


def _compare(bases: dict[int, np.ndarray], tiles: Tiles):
    """The work on one pair of tiles: links of every vector, and its least fellow reached here."""

    def links(x: np.ndarray, y: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
        ux, uy = _unit(x), _unit(y)
        px, py = _projected(ux, bases, tiles), _projected(uy, bases, tiles)
        least = tiles.threshold - SLACK
        steps = sorted({min(n, px.shape[1]) for n in (tiles.leading, 3 * tiles.leading, px.shape[1])})
        rests = [(_rest(px, n), _rest(py, n)) for n in steps]
        found = []
        for start in range(0, len(x), tiles.block):
            stop = min(start + tiles.block, len(x))
            sums = px[start:stop, : steps[0]] @ py[:, : steps[0]].T
            a, b = np.nonzero(sums + np.outer(rests[0][0][start:stop], rests[0][1]) >= least)
            if same:
                later = b > a + start
                a, b = a[later], b[later]
            sums, a = sums[a, b], a + start
            for (done, upto), (rx, ry) in zip(zip(steps, steps[1:], strict=False), rests[1:], strict=True):
                sums = sums + np.einsum("ij,ij->i", px[a, done:upto], py[b, done:upto])
                open_ = sums + rx[a] * ry[b] >= least
                a, b, sums = a[open_], b[open_], sums[open_]
            lengths = np.sqrt(np.einsum("ij,ij->i", x[a], x[a]) * np.einsum("ij,ij->i", y[b], y[b]))
            dots = np.einsum("ij,ij->i", x[a], y[b])
            with np.errstate(all="ignore"):
                cosine = dots / lengths
            odd = ~np.isfinite(cosine) | (lengths == 0)
            cosine[odd] = np.einsum("ij,ij->i", ux[a[odd]], uy[b[odd]])
            hit = cosine >= tiles.threshold
            found.append((a[hit], b[hit]))
        return tuple(np.concatenate(part) for part in zip(*found, strict=True))

    def run(table: pa.Table) -> pa.Table:
        sides = np.asarray(table["side"])
        same = not (sides == 1).any()
        left = np.flatnonzero(sides == 0)
        right = left if same else np.flatnonzero(sides == 1)
        vectors = _matrix(table["vector"])
        a, b = links(vectors[left], vectors[right], same)
        a, b = left[a], right[b]
        weight = np.asarray(table["weight"])
        counts = np.bincount(a, weight[b], len(sides)) + np.bincount(b, weight[a], len(sides))
        order = np.asarray(table["least"])
        rank = np.argsort(np.argsort(order, kind="stable"), kind="stable")
        by_rank = np.argsort(rank, kind="stable")
        p, q, root = rank[a], rank[b], np.arange(len(sides))
        while True:
            low = np.minimum(root[p], root[q])
            after = root.copy()
            np.minimum.at(after, p, low)
            np.minimum.at(after, q, low)
            np.minimum.at(after, root[p], low)
            np.minimum.at(after, root[q], low)
            after = after[after]
            if (after == root).all():
                break
            root = after
        linked = np.flatnonzero(counts)
        return pa.table(
            {
                "least": pa.array(order[linked], pa.int64()),
                "hash": table["hash"].take(pa.array(linked)),
                "links": pa.array(counts[linked].astype(np.int64)),
                "root": pa.array(order[by_rank[root[rank[linked]]]], pa.int64()),
            }
        )

    return run


def near_vectors(
    vectors: DataFrame, tiles: Tiles = Tiles(), key: str = "vec_id", vector: str = "embedding", label: str = "label"
) -> DataFrame:
    """One row per vector: key, ``n_links`` (other vectors linked directly), ``component_id``.

    Vectors link when their labels are equal and not null, their lengths equal, and their cosine in
    double precision reaches the threshold. Null, empty and zero vectors and those with null or
    non-finite components link with nothing. Equal vectors of a label form a class, compared once
    and counted by its rows, so a vector with a third of all rows costs no more than another.
    Rows that share a key are one node of the components but are counted each. A null key is a node
    of no component. An empty table gives no rows; other columns are ignored.

    Classes stand in tiles by first principal component of their label and length. Pairs of tiles whose boxes
    cannot reach the threshold are passed over; in the others products are summed from the
    leading component on, and a pair is given up once the rest's norms cannot fill the gap. Tasks
    give link counts and local components, never all pairs.
    """
    ship_code(vectors.sparkSession)
    kind = vectors.schema[vector].dataType
    element = "float" if isinstance(kind, ArrayType) and isinstance(kind.elementType, FloatType) else "double"
    rows = vectors.select(
        vectors[key].cast("long").alias("key"),
        vectors[label].cast("string").alias("label"),
        vectors[vector].cast(f"array<{element}>").alias("vector"),
    )
    classes = stored(
        rows.filter(F.col("label").isNotNull() & usable(F.col("vector")))
        .groupBy("label", "vector")
        .agg(F.min("key").alias("least"), F.count(F.lit(1)).alias("weight"))
        .withColumns({"hash": F.xxhash64("label", "vector"), "length": F.size("vector")}),
        "vector-classes",
    )
    bases = _bases(classes, classes.count(), tiles)
    tiled = stored(_tiled(_led(classes, bases, tiles), tiles), "vector-tiles")
    pairs = stored(_tile_pairs(tiled, tiles), "vector-tile-pairs")
    slim = tiled.select("label", "length", "tile", "least", "hash", "weight", "vector")

    def dealt(column: str, side: int) -> DataFrame:
        chosen = pairs if side == 0 else pairs.filter("i < j")
        return slim.join(chosen.withColumn("tile", F.col(column)), ["label", "length", "tile"]).select(
            "label", "length", "i", "j", F.lit(side).alias("side"), "least", "hash", "weight", "vector"
        )

    found = stored(
        dealt("i", 0).unionByName(dealt("j", 1))
        .filter("least is not null")
        .groupBy("label", "length", "i", "j")
        .applyInArrow(_compare(bases, tiles), "least long, hash long, links long, root long"),
        "vector-links",
    )
    joined = components(found.select(F.col("least").alias("a"), F.col("root").alias("b")).distinct())
    counts = found.groupBy("least", "hash").agg(F.sum("links").alias("links"))
    named = (
        classes.select(F.col("label").alias("of"), F.col("vector").alias("value"), "least", "weight", "hash")
        .join(counts, ["least", "hash"], "left")
        .join(joined, F.col("least") == F.col("node"), "left")
        .select("of", "value", "weight", "links", F.coalesce("component", "least").alias("component"))
    )
    return rows.join(named, (F.col("label") == F.col("of")) & (F.col("vector") == F.col("value")), "left").select(
        F.col("key").alias(key),
        F.coalesce(F.col("links") + F.col("weight") - 1, F.col("weight") - 1, F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("key").isNotNull(), F.coalesce("component", "key")).alias("component_id"),
    )


def op2_vector_dedup(spark, sf_dir: str) -> DataFrame:
    found = near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return found.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
