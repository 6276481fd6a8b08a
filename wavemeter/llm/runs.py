"""Periodic runs of words: seeds of repeated word grams extended along their diagonal."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wavemeter.llm.expressions import let, ship_code, text_of, words

# Words of several short texts that are searched together; one longer text is searched alone.
CHUNK_WORDS = 300_000
LEAST_LENGTH = 6
LEAST_EXPONENT = 4


class _Numbers(dict):
    """A number for every new key."""

    def __missing__(self, key) -> int:
        self[key] = number = len(self)
        return number


def _common(a: np.ndarray, b: np.ndarray) -> int:
    """How many leading values of two arrays are equal."""
    n, at, step = min(len(a), len(b)), 0, 32
    while at < n:
        stop = min(n, at + step)
        differ = a[at:stop] != b[at:stop]
        first = int(differ.argmax())
        if differ[first]:
            return at + first
        at, step = stop, 2 * step
    return n


def _renamed(keys: np.ndarray, places: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Names of the keys that occur twice or more (-1 elsewhere), and their places by name, then place."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    fresh = np.ones(len(keys), bool)
    fresh[1:] = ranked[1:] != ranked[:-1]
    group = np.cumsum(fresh) - 1
    often = np.bincount(group)[group] > 1 if len(keys) else fresh
    names = np.full(size, -1, np.int64)
    names[places[order[often]]] = group[often]
    return names, places[order[often]]


def _joined(left: np.ndarray, right: np.ndarray, shift: int) -> tuple[np.ndarray, np.ndarray]:
    """Names of the grams made of ``left`` and, ``shift`` words on, ``right``."""
    places = np.flatnonzero(left[: max(0, len(left) - shift)] >= 0)
    places = places[right[places + shift] >= 0]
    keys = left[places] * (len(left) + 1) + right[places + shift]
    return _renamed(keys, places, len(left))


def diagonal_runs(tokens: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run in an array whose texts use numbers of their own.

    A lag q from 2^c up to 2^(c+1) - 1 is seeded by grams of 3 * 2^c words: a run of that period
    repeats so many words at least at lag q, and because the gram is longer than the period
    its next occurrence lies exactly one period on. So neighbouring occurrences of a gram are
    all the pairs there are to look at. For each lag the place up to which it was extended is
    kept, and seeds before it are passed over.
    """
    n = len(tokens)
    ones, _ = _renamed(tokens, np.arange(n), n)
    twos, _ = _joined(ones, ones, 1)
    grams, places = _joined(twos, ones, 2)
    found, size, least = [], 3, 1
    while len(places):
        first, second = places[:-1], places[1:]
        lag = second - first
        seeds = np.flatnonzero((grams[first] == grams[second]) & (lag >= least) & (lag < 2 * least))
        seeds = seeds[np.lexsort((first[seeds], lag[seeds]))]
        at, q = first[seeds], lag[seeds]
        begins = np.ones(len(at), bool)
        begins[1:] = (at[1:] != at[:-1] + 1) | (q[1:] != q[:-1])
        covered: dict[int, int] = {}
        for i, period in zip(at[begins].tolist(), q[begins].tolist(), strict=True):
            if i < covered.get(period, 0):
                continue
            end = i + size + _common(tokens[i + size :], tokens[i + size + period :])
            start = i - _common(tokens[:i][::-1], tokens[: i + period][::-1])
            covered[period] = end
            length = end - start + period
            if length >= max(LEAST_LENGTH, LEAST_EXPONENT * period):
                found.append((start, length, period))
        grams, places = _joined(grams, grams, size)
        size, least = 2 * size, 2 * least
    return sorted(found, key=lambda run: (run[0], run[2]))


def _searched(texts: list[list[bytes]]) -> Iterator[tuple[list[bytes], list[tuple[int, int, int]]]]:
    """Each text's words and runs; the texts are searched together."""
    known = _Numbers()
    tokens = np.fromiter((known[n, w] for n, ws in enumerate(texts) for w in ws), np.int64)
    ends = np.cumsum([len(ws) for ws in texts])
    runs = diagonal_runs(tokens)
    owner = np.searchsorted(ends, [r[0] for r in runs], side="right")
    mine: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for text, (start, length, period) in zip(owner.tolist(), runs, strict=True):
        mine[text].append((start - int(ends[text]) + len(texts[text]), length, period))
    yield from zip(texts, mine, strict=True)


def _collapsed(ws: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that no run drops, joined by one space."""
    if not runs:
        return b" ".join(ws)
    change = np.zeros(len(ws) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return b" ".join([ws[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()])


def periodic_runs(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row: key, ``n_words``, ``runs`` (start, length, period by start, then period), ``collapsed``.

    Words are separated by ASCII white space and numbered from 0. A run is a stretch with smallest
    period q, of ``max(6, 4 * q)`` words or more, that no neighbouring word extends. ``collapsed``
    holds the words that no run contains behind its first period, joined by one space.

    Null, empty and blank texts have no words, no runs and an empty ``collapsed``; repeated rows
    and null keys each give a row of their own; an empty table gives no rows; other columns are
    ignored. Texts are searched whole, whatever their length; rows are independent, so nothing
    is shuffled. A text is held by one task with some 100 bytes a word.
    """
    ship_code(docs.sparkSession)
    run_kind = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))

    def chunks(batch) -> Iterator[list[list[bytes]]]:
        held, size = [], 0
        for value in batch["_text"]:
            ws = (value.as_py() or "").encode().split()
            if held and size + len(ws) > CHUNK_WORDS:
                yield held
                held, size = [], 0
            held.append(ws)
            size += len(ws)
        if held:
            yield held

    def search(batches):
        for batch in batches:
            counts, runs, texts = [], [], []
            for chunk in chunks(batch):
                for ws, found in _searched(chunk):
                    counts.append(len(ws))
                    runs.append([{"start": s, "length": n, "period": q} for s, n, q in found])
                    texts.append(_collapsed(ws, found).decode())
            yield pa.RecordBatch.from_arrays(
                [batch["_key"], pa.array(counts, pa.int64()), pa.array(runs, run_kind), pa.array(texts, pa.string())],
                names=[key, "n_words", "runs", "collapsed"],
            )

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(docs[key].alias("_key"), docs[text].cast("string").alias("_text")).mapInArrow(
        search,
        f"`{key}` {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string",
    )


def looped(key: Column, text: Column) -> Column:
    """The text, or for every tenth checksum of a key a text whose words repeat with one period.

    With h the checksum and g = floor(h / 10), word i >= a becomes word a + (i - a) % p, where
    a = g % n and p = 1 + floor((n - a) / (3 + g % 8)). A null key leaves the text as it is.
    """
    whole, check = text_of(text), F.crc32(key.cast("string"))
    g = F.floor(check / 10)

    def repeat(ws: Column) -> Column:
        n = F.size(ws).cast("long")
        a = F.pmod(g, n)
        p = F.lit(1) + F.floor((n - a) / (F.lit(3) + F.pmod(g, F.lit(8))))
        times = F.ceil((n - a) / p).cast("int")
        body = F.flatten(F.array_repeat(F.slice(ws, (a + 1).cast("int"), p.cast("int")), times))
        looped_words = F.concat(F.slice(ws, F.lit(1), a.cast("int")), F.slice(body, F.lit(1), (n - a).cast("int")))
        return F.when(n > 0, F.array_join(looped_words, " ")).otherwise(F.lit(""))

    return F.when(check % 10 == 0, let(words(whole), repeat)).otherwise(whole)


def op12_periodic_runs(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = periodic_runs(docs.select("doc_id", looped(F.col("doc_id"), F.col("text")).alias("text")))
    listed = F.transform("runs", lambda r: F.format_string("%d,%d,%d\n", r["start"], r["length"], r["period"]))
    # The greatest length, then the least start and period.
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"], r["period"])))
    return found.withColumn("_best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("_best")["col2"]).alias("start"),
        F.col("_best")["length"].alias("length"),
        F.col("_best")["period"].alias("period"),
        F.floor(F.lit(1000) * F.col("_best")["length"] / F.col("_best")["period"]).alias("exponent_milli"),
        F.sha2(F.array_join(listed, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
