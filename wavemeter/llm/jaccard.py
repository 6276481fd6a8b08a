"""Exact Jaccard join of shingle sets by partitions of the universe."""

from __future__ import annotations

import functools
import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wavemeter.llm.components import components
from wavemeter.llm.expressions import ship_code, short_list, stored
from wavemeter.llm.shingles import in_groups, mix, shingle_sets
from wavemeter.llm.workers import hold

# Sets of one signature that are compared with as many others in one run.
BLOCK = 2048

# The part of rows that tell of a set itself, and what is added to its lack to keep that above 0.
NOTE, LACK_BASE = 255, 1 << 25
# Bands of sets so small (below 64 shingles) that some have too few filled segments; always opened.
SMALL_BANDS = 0b111111
# Probes of a set that are compared before the others.
FIRST_PROBES = 2


@dataclass(frozen=True)
class Join:
    """Sets link when intersection / union >= ``over`` / ``under``.

    ``spare`` is the share of segments beyond those the pigeonhole needs, so that frequent ones can
    be passed over; ``deletions`` is the share that also index their one-deletion neighbourhoods.
    ``sample`` documents tell which signatures are frequent (``hot`` of them or more); their groups
    are dealt out in ``salts`` parts. The sample changes the work alone, never the result.
    """

    over: int = 3
    under: int = 4
    spare: float = 0.25
    deletions: float = 0.03
    sample: int = 4_000
    hot: int = 20
    salts: int = 64
    seed: int = 1

    def larger(self, n: int) -> int:
        """Most shingles of a set that can link with one of n."""
        return n * self.under // self.over

    def differ(self, total: int) -> int:
        """Most shingles by which two linked sets of so many together differ."""
        return (self.under - self.over) * total // (self.under + self.over)


def _segments(join: Join, band: int) -> tuple[int, int]:
    """Segments of a size band (sizes 2^band to 2^(band+1) - 1), and how many index deletions."""
    needed = join.differ(2 * (2 ** (band + 1) - 1)) + 1
    count = needed + int(join.spare * needed) + 4
    return count, int(join.deletions * count) + 2


def index_rows(values: np.ndarray, join: Join, open_bands: int = 0) -> Iterator[tuple]:
    """Index rows of one set by band: arrays (signature, near, whole), whether own, and the lack.

    A set is indexed in the band of its size, where larger sets are its partners, and it probes the
    next band, if a set there could link. Every filled segment gives the signature of its whole content;
    the first segments of four shingles or more (``near`` is their number, else -1) also those of the
    content but one. In the next band, where nobody looks for it, a set gives its fullest segments
    alone. The lack is what the pigeonhole asks for beyond one for each segment given and one
    for each near one. Empty segments are indexed in ``open_bands`` alone, where some set has too few.
    """
    own = len(values).bit_length() - 1
    for band, spread, segment, needed, count, deleting in _partitions(values, join):
        sizes = np.bincount(segment, minlength=count)
        filled = np.flatnonzero(sizes)
        first = (np.cumsum(sizes) - sizes)[filled]
        sums = np.add.reduceat(spread, first)
        given = np.ones(len(filled), bool)
        if band > own:
            given[np.argsort(-sizes[filled], kind="stable")[needed + int(join.spare * needed) + 2 :]] = False
        label = _labels(band, count)
        near = (filled < deleting) & (sizes[filled] >= 4) & given
        of = np.repeat(np.arange(len(filled)), sizes[filled])
        chosen = near[of]
        of = of[chosen]
        parts = [mix(sums ^ label[filled])[given], mix((sums[of] - spread[chosen]) ^ label[filled[of]])]
        nears = [np.where(near, filled, -1)[given], filled[of]]
        whole = [np.ones(int(given.sum()), bool), np.zeros(len(of), bool)]
        if open_bands >> band & 1:
            empty = np.flatnonzero(sizes == 0)
            parts.append(mix(label[empty] ^ np.uint64(0xE)))
            nears.append(np.full(len(empty), -1))
            whole.append(np.ones(len(empty), bool))
        n_given = sum(int(w.sum()) for w in whole)
        rows = (np.concatenate(parts), np.concatenate(nears), np.concatenate(whole))
        yield *rows, band == own, needed - n_given - int(near.sum())


def _bands(n: int, join: Join) -> Iterator[tuple[int, int, int, int]]:
    """Band, segments needed, all, and indexing deletions, of every band a set of n is in."""
    own = n.bit_length() - 1
    for band in (own, own + 1):
        if band > own and join.larger(n) < 2**band:
            return
        count, deleting = _segments(join, band)
        yield band, join.differ(n + min(join.larger(n), 2 ** (band + 1) - 1)) + 1, count, deleting


def _spread(values: np.ndarray, join: Join, band: int) -> np.ndarray:
    return mix(values ^ mix(np.array([join.seed + 1000 * band], np.uint64)))


@functools.cache
def _labels(band: int, count: int) -> np.ndarray:
    return mix(np.arange(count, dtype=np.uint64) + np.uint64(band << 32))


def _partitions(values: np.ndarray, join: Join) -> Iterator[tuple]:
    """Per band: band, spread shingles by segment, their segments, segments needed, all, deleting."""
    for band, needed, count, deleting in _bands(len(values), join):
        spread = _spread(values, join, band)
        segment = (spread % np.uint64(count)).astype(np.uint16 if count < 1 << 16 else np.int64)
        order = np.argsort(segment, kind="stable")
        yield band, mix(spread[order]), segment[order].astype(np.int64), needed, count, deleting


def _member(values: np.ndarray, ascending: np.ndarray) -> np.ndarray:
    if not len(ascending):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(ascending, values), len(ascending) - 1)
    return ascending[at] == values


def parity_bits(values: np.ndarray) -> bytes:
    """Bitmap of at least two bits a shingle, eight in small sets; every shingle turns one bit over.

    Bits that differ between two sets' maps are shingles by which the sets differ, at least.
    """
    bits = 1 << max(6, ((8 if len(values) <= 200 else 2) * len(values) - 1).bit_length())
    odd = np.bincount((values % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def _differing(a: bytes, b: bytes) -> int:
    x, y = sorted((np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)), key=len)
    if len(y) > len(x):
        y = np.bitwise_xor.reduce(y.reshape(-1, len(x)), axis=0)
    return int(np.bitwise_count(x ^ y).sum())


def _sets(batch: pa.RecordBatch) -> Iterator[tuple[int | None, np.ndarray]]:
    docs = batch["doc"].to_pylist()
    for start, texts in in_groups(batch["text"]):
        yield from zip(docs[start : start + len(texts)], shingle_sets(texts), strict=True)


def _maps(docs: DataFrame) -> DataFrame:
    """(doc, n, bits) of every row of (doc, text)."""

    def run(batches):
        for batch in batches:
            made = [(doc, len(values), parity_bits(values)) for doc, values in _sets(batch)]
            columns = zip(*made, strict=True) if made else [()] * 3
            kinds = (pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["doc", "n", "bits"]
            )

    return docs.mapInArrow(run, "doc long, n long, bits binary")


def _indexed(docs: DataFrame, join: Join, hot: np.ndarray, open_bands: int) -> DataFrame:
    """Index rows (sig, doc, code) of every row of (doc, text); ``part`` is 0 but for frequent ones.

    The code packs part, whole, own and near, as these rows are most of what is shuffled.
    """
    names = ["sig", "doc", "code"]

    def batch_of(parts: list) -> pa.RecordBatch:
        made = (np.concatenate(c) for c in zip(*parts, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in made], names=names)

    def run(batches):
        parts, held = [], 0
        for batch in batches:
            for doc, values in _sets(batch):
                if not len(values):
                    continue
                salt = 1 + int(mix(np.array([doc], np.int64).view(np.uint64))[0] % np.uint64(join.salts))
                for sigs, near, whole, own, lack in index_rows(values, join, open_bands):
                    part = np.where(_member(sigs, hot), salt, 0)
                    code = part | whole.astype(np.int64) << 8 | int(own) << 9 | (near.astype(np.int64) + 1) << 10
                    # One row of each band tells size, lack, and whether that leaves too few segments.
                    short = int(lack + int((near[whole] >= 0).sum()) > 0)
                    told = (len(values) << 27 | (lack + LACK_BASE) << 1 | short) << 10 | int(own) << 9 | NOTE
                    note = (np.array([doc]), np.array([doc]), np.array([told]))
                    parts += [(sigs.view(np.int64), np.full(len(sigs), doc), code), note]
                    held += len(sigs)
                if held > 100_000:
                    yield batch_of(parts)
                    parts, held = [], 0
        if parts:
            yield batch_of(parts)

    return docs.mapInArrow(run, "sig long, doc long, code long").select(
        "sig",
        "doc",
        F.col("code").bitwiseAND(255).cast("short").alias("part"),
        "code",
    )


def _frequent(docs: DataFrame, rows: int, join: Join) -> np.ndarray:
    """Signatures that ``hot`` documents or more of a sample share, ascending.

    The sample is about ``sample`` documents by hash, whatever the input; the list holds its index
    rows over ``hot`` at most, so it is bounded by both parameters and the length of a document.
    """
    step = max(1, rows // join.sample)
    sampled = docs.filter(F.pmod(F.xxhash64("doc"), F.lit(step)) == 0)
    found = (
        _indexed(sampled, join, np.empty(0, np.uint64), SMALL_BANDS)
        .filter(F.col("part") != NOTE)
        .groupBy("sig").count().filter(F.col("count") >= join.hot).select("sig").toArrow()
    )
    return np.sort(np.asarray(found["sig"], np.int64).view(np.uint64))


def _near(pairs: DataFrame, bits: DataFrame, join: Join) -> DataFrame:
    """The pairs (a, b) whose sizes and bitmaps leave it open that they link."""

    def run(batches):
        hold("bitmaps", lambda: None)
        for batch in batches:
            rows = zip(*(batch[c].to_pylist() for c in ("bits_a", "bits_b", "n_a", "n_b")), strict=True)
            keep = [_differing(x, y) <= join.differ(n + m) for x, y, n, m in rows]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    def side(name: str) -> DataFrame:
        return bits.select(F.col("doc").alias(name), F.col("n").alias(f"n_{name}"), F.col("bits").alias(f"bits_{name}"))

    least, most = F.least("n_a", "n_b"), F.greatest("n_a", "n_b")
    return (
        pairs.join(side("a"), "a").join(side("b"), "b")
        .filter(join.under * least >= join.over * most)
        .select("a", "b", "n_a", "n_b", "bits_a", "bits_b")
        .mapInArrow(run, "a long, b long")
    )


def _verified(pairs: DataFrame, docs: DataFrame, join: Join) -> DataFrame:
    """The stored pairs (a, b) that link, by intersection of their whole sets."""

    def run(batches):
        for batch in batches:
            values = [own.view(np.int64) for _, own in _sets(batch)]
            offsets = np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int32)
            flat = np.concatenate([*values, np.empty(0, np.int64)])
            yield pa.RecordBatch.from_arrays(
                [batch["doc"], pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int64()))],
                names=["doc", "values"],
            )

    members = pairs.select(F.col("a").alias("doc")).union(pairs.select(F.col("b").alias("doc"))).distinct()
    sets = stored(docs.join(short_list(members), "doc", "left_semi").mapInArrow(run, "doc long, values array<long>"), "jaccard-sets")
    both = F.size(F.array_intersect("x", "y"))
    return (
        pairs.join(sets.select(F.col("doc").alias("a"), F.col("values").alias("x")), "a")
        .join(sets.select(F.col("doc").alias("b"), F.col("values").alias("y")), "b")
        .filter(join.under * both >= join.over * (F.size("x") + F.size("y") - both))
        .select("a", "b")
    )


def jaccard_join(docs: DataFrame, join: Join = Join(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: key, ``n_shingles``, ``component_id``.

    Rows with equal texts form a class, whose least key stands for it. The classes' sets are indexed
    by signatures of their segments. Each signature first ties its sets to its least one; then, where
    a signature still joins several components, every pair across components is compared, so no
    link is lost. Candidates are held against bitmaps, then against whole sets.

    A null, empty or blank text has no shingles and is alone; a null key has a null component.
    Rows that share a key are one node, so repeated rows agree. An empty table gives no rows; other
    columns are ignored. Frequent signatures are dealt out in parts; sets are never gathered.
    """
    ship_code(docs.sparkSession)
    docs = docs.select(docs[key].cast("long").alias("doc"), docs[text].cast("string").alias("text"))
    members = stored(
        docs.select("doc", F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256)).alias("hash")), "jaccard-docs"
    )
    known = members.filter("doc is not null")
    classes = stored(
        known.groupBy("hash").agg(F.min("doc").alias("least"), F.count(F.lit(1)).alias("rows")), "jaccard-classes"
    )
    single = classes.select(F.col("least").alias("doc")).distinct()
    # Texts stay where they are read if the list of copies to leave out is short.
    copies = known.join(classes, "hash").filter("doc != least").select("doc").distinct()
    copies = copies.join(single, "doc", "left_anti")
    chosen = docs.filter("doc is not null").join(short_list(copies), "doc", "left_anti")
    hot = _frequent(docs.filter("doc is not null"), classes.agg(F.sum("rows")).first()[0] or 0, join)

    shared = _met(_indexed(chosen, join, hot, SMALL_BANDS))
    opened = _open_bands(shared)
    if opened:
        shared = _met(_indexed(chosen, join, hot, SMALL_BANDS | opened))
    probed = _probed(shared)
    met = stored(probed.select("doc").distinct(), "jaccard-met")
    maps = stored(_maps(docs.join(short_list(met), "doc", "left_semi")), "jaccard-maps")

    def links_of(pairs: DataFrame) -> DataFrame:
        near = stored(_near(pairs, maps, join), "jaccard-pairs")
        return stored(_verified(near, docs, join), "jaccard-links")

    links = links_of(_star_pairs(probed))
    found = stored(components(links), "jaccard-components")
    for probes in (FIRST_PROBES, None):
        more = links_of(_cross_pairs(probed, found, maps, join, probes))
        if not more.isEmpty():
            links = links.unionByName(more)
            found = stored(components(links), "jaccard-components")
    sizes = shared.filter((F.col("part") == NOTE) & F.col("own")).select(F.col("doc").alias("of"), "n").distinct()
    named = (
        members.join(classes, "hash", "left")
        .join(sizes, F.col("least") == F.col("of"), "left")
        .join(found, F.col("least") == F.col("node"), "left")
    )
    return named.select(
        F.col("doc").alias(key),
        F.coalesce("n", F.lit(0)).cast("long").alias("n_shingles"),
        # Equal texts without a shingle link with nothing.
        F.when(F.col("n").isNull(), F.col("doc")).when(F.col("doc").isNotNull(), F.coalesce("component", "least")).alias("component_id"),
    )


def _met(rows: DataFrame) -> DataFrame:
    """Index rows that share their signature, with the group's least set, and the notes; stored."""
    group = Window.partitionBy("sig", "part")
    whole, own = (F.col("code").bitwiseAND(1 << n) != 0 for n in (8, 9))
    upper, note = F.shiftright("code", 10), F.col("part") == NOTE
    lack = F.shiftright(upper, 1).bitwiseAND(2 * LACK_BASE - 1) - LACK_BASE
    return stored(
        rows.withColumns(
            {
                "held": F.count(F.lit(1)).over(group),
                "centre": F.coalesce(F.min(F.when(own & whole, F.col("doc"))).over(group), F.min("doc").over(group)),
            }
        )
        .filter("part > 0 or held > 1")
        .select(
            "sig", "part", "doc", "held", "centre", (whole & ~note).alias("whole"), own.alias("own"),
            F.when(~note & (upper > 0), upper).alias("near"),
            F.when(note, lack).alias("lack"),
            F.when(note, F.shiftright(upper, 27)).alias("n"),
            F.when(note, upper.bitwiseAND(1) != 0).alias("short"),
        ),
        "jaccard-shared",
    )


def _open_bands(shared: DataFrame) -> int:
    """Bits of the bands in which some set has fewer filled segments than needed."""
    band = F.length(F.bin("n")) - F.when(F.col("own"), 1).otherwise(0)
    return sum(1 << r["band"] for r in shared.filter("short").select(band.alias("band")).distinct().collect())


def _probed(shared: DataFrame) -> DataFrame:
    """Index rows whose signature some set probes for; stored. ``probe`` counts a set's probes from 1.

    Allowances by cost: a signature that one set alone has costs nothing, so those segments are
    probed first, and the near ones among them, whose neighbours are alone too, with an allowance of
    one shingle, which counts for two. What the pigeonhole still asks for is probed among the shared
    signatures, least frequent first. The other shared ones are passed over. A set that shares few
    of its segments therefore has no candidate at all. Frequent ones, in parts, come last.
    """
    of_set = Window.partitionBy("doc", "own")
    wholes = F.sum(F.col("whole").cast("int")).over(of_set)
    met = F.size(F.collect_set("near").over(of_set))
    rank = F.row_number().over(Window.partitionBy("doc", "own", "whole").orderBy("part", "held", "sig"))
    asked = F.col("whole") & (rank <= F.max("lack").over(of_set) + wholes + met)
    marked = stored(
        shared.withColumn("probe", F.when(asked, rank))
        .filter(F.col("part") != NOTE)
        .select("sig", "part", "doc", "centre", "own", "probe"),
        "jaccard-marked",
    )
    wanted = marked.filter("probe is not null").select("sig").distinct()
    return stored(marked.join(wanted, "sig", "left_semi"), "jaccard-probed")


def _star_pairs(shared: DataFrame) -> DataFrame:
    """Distinct pairs (a, b): every probing set with its group's least, and the parts' least ones."""
    probing = shared.filter("probe is not null")
    heads = probing.filter("part > 0").select("sig", "centre").distinct()
    tops = heads.groupBy("sig").agg(F.min("centre").alias("top"))
    arms = probing.select(F.col("doc").alias("x"), F.col("centre").alias("y")).unionByName(
        heads.join(tops, "sig").select(F.col("centre").alias("x"), F.col("top").alias("y"))
    )
    return arms.filter("x != y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def _cross_pairs(shared: DataFrame, found: DataFrame, bits: DataFrame, join: Join, probes: int | None) -> DataFrame:
    """Distinct pairs (a, b) of different components, one probing a signature of the other.

    Sets are compared block by block inside tasks, bitmap against bitmap; only pairs that may link
    come out, so a group of many near copies that do not quite link gives few rows. With
    ``probes`` only that many of each set are used; they join most components before the rest.
    """
    used = F.col("probe").isNotNull() if probes is None else F.col("probe") <= probes
    named = shared.join(found, F.col("doc") == F.col("node"), "left").select(
        "sig", "doc", "own", F.coalesce(used, F.lit(False)).alias("probe"), F.coalesce("component", "doc").alias("component")
    )
    mixed = (
        named.groupBy("sig")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"), F.max("probe").alias("probing"))
        .filter("low < high and probing")
        .select("sig")
    )
    rows = named.join(mixed, "sig")
    return _dealt(rows, bits).mapInArrow(_block_pairs(join), "a long, b long").distinct()


def _dealt(rows: DataFrame, bits: DataFrame) -> DataFrame:
    """Rows of mixed signatures by blocks of probing and of indexed sets, sorted by block.

    A signature of many sets is cut into as many blocks as its counted sizes ask for, and every
    block of probes meets every block of indexed sets in a run of its own.
    """
    sides = rows.select(
        "sig", "doc", "component", F.explode(F.array_compact(F.array(F.when(F.col("probe"), 0), F.when(F.col("own"), 1)))).alias("side")
    ).distinct()
    sizes = sides.groupBy("sig").agg(
        *(F.ceil(F.sum((F.col("side") == side).cast("int")) / BLOCK).cast("int").alias(f"blocks_{side}") for side in (0, 1))
    )
    place = F.pmod(F.xxhash64("doc"), F.when(F.col("side") == 0, F.col("blocks_0")).otherwise(F.col("blocks_1"))).cast("int")
    others = F.when(F.col("side") == 0, F.col("blocks_1")).otherwise(F.col("blocks_0"))
    met = sides.join(sizes.filter("blocks_0 > 0 and blocks_1 > 0"), "sig").select(
        "sig", "doc", "component", "side", place.alias("own_block"), F.explode(F.sequence(F.lit(0), others - 1)).alias("other")
    )
    block = F.when(F.col("side") == 0, F.struct(F.col("own_block").alias("x"), F.col("other").alias("y"))).otherwise(
        F.struct(F.col("other").alias("x"), F.col("own_block").alias("y"))
    )
    return (
        met.withColumn("block", F.xxhash64("sig", block))
        .join(bits, "doc")
        .select("block", "side", "doc", "component", "n", "bits")
        .repartition("block")
        .sortWithinPartitions("block")
    )


def _block_pairs(join: Join):
    """Pairs (a, b) of each block that sizes and bitmaps leave open, of different components."""

    def folded(maps: list[bytes]) -> np.ndarray:
        width = min(map(len, maps))
        out = np.empty((len(maps), width // 8), np.uint64)
        lengths = np.fromiter(map(len, maps), np.int64, len(maps))
        for length in np.unique(lengths):
            at = np.flatnonzero(lengths == length)
            stacked = np.frombuffer(b"".join(maps[i] for i in at), np.uint64).reshape(len(at), length // width, width // 8)
            out[at] = np.bitwise_xor.reduce(stacked, axis=1)
        return out

    def compared(doc, component, n, side, maps) -> tuple[np.ndarray, np.ndarray]:
        x, y = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        found = [(doc[:0], doc[:0])]
        if len(x) and len(y) and (component != component[0]).any():
            words = folded(maps)
            step = max(1, 2_000_000 // (len(y) * words.shape[1]))
            for start in range(0, len(x), step):
                some = x[start : start + step]
                small, large = n[some][:, None], n[y][None]
                open_ = (component[some][:, None] != component[y]) & (small <= large) & (join.under * small >= join.over * large)
                if not open_.any():
                    continue
                differ = np.bitwise_count(words[some][:, None] ^ words[y][None]).sum(2, dtype=np.int64)
                most = (join.under - join.over) * (small + large) // (join.under + join.over)
                i, j = np.nonzero(open_ & (differ <= most))
                found.append((doc[some[i]], doc[y[j]]))
        a, b = (np.concatenate(c) for c in zip(*found, strict=True))
        return np.minimum(a, b), np.maximum(a, b)

    def run(batches):
        hold("bitmaps", lambda: None)
        rest = None
        for batch in itertools.chain(batches, [None]):
            if batch is not None:
                rest = pa.Table.from_batches([batch]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([batch])])
            if rest is None:
                return
            block = rest["block"].to_numpy()
            cuts = np.flatnonzero(np.diff(block)) + 1
            done = len(block) if batch is None else int(cuts[-1]) if len(cuts) else 0
            whole, rest = rest.slice(0, done), rest.slice(done)
            doc, component, n, side = (whole[c].to_numpy() for c in ("doc", "component", "n", "side"))
            maps = whole["bits"].to_pylist()
            bounds = [0, *(c for c in cuts.tolist() if c < done), done]
            pairs = [
                compared(doc[p:q], component[p:q], n[p:q].astype(np.int64), side[p:q], maps[p:q])
                for p, q in zip(bounds, bounds[1:], strict=False)
                if q - p > 1
            ]
            if pairs:
                a, b = (np.concatenate(c) for c in zip(*pairs, strict=True))
                kept = np.unique(np.stack([a, b]), axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(kept[0], pa.int64()), pa.array(kept[1], pa.int64())], names=["a", "b"])

    return run


def same_components(docs: DataFrame, found: DataFrame, key: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that stand for their component: key equal to it, or null."""
    named = found.select(F.col(key).alias("_llm_key"), "component_id").filter("_llm_key = component_id")
    kept = named.select("_llm_key").distinct()
    return docs.join(kept, docs[key].cast("long") == kept["_llm_key"], "left_semi").unionByName(
        docs.filter(docs[key].isNull())
    )


def op8_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return jaccard_join(spark.read.parquet(f"{sf_dir}/documents.parquet"))
