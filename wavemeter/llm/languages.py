"""Language of a text: known words first, ever shorter character grams for the others."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wavemeter.llm.expressions import ship_code, stored, text_of

UNKNOWN = "und"
# What separates words: all but letters and the marks that belong to them.
BREAK = r"[^\p{L}\p{M}]+"
EDGE = "_"


@dataclass(frozen=True)
class Fit:
    """Size of the model: the (word, language) and (gram, language) pairs it holds at most.

    The most frequent are held; their counts are of all training texts. ``order`` is the longest gram.
    """

    words: int = 150_000
    grams: int = 100_000
    order: int = 4


# Rows of the histogram by which the most frequent are chosen: so many for each doubling of a count.
STEPS = 16
# Words that a task scores at once.
CHUNK_WORDS = 1_000_000


def _tokens(text: Column) -> Column:
    """Lower-case words; an empty string may stand among them."""
    return F.split(F.lower(text_of(text)), BREAK)


def _grams(word: Column, order: int) -> Column:
    """Grams of one to ``order`` characters of a word with both its edges marked."""
    edged = F.concat(F.lit(EDGE), word, F.lit(EDGE))
    size = F.length(edged)

    def of(k: int) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(size - k + 1, F.lit(1)))
        return F.when(size >= k, F.transform(starts, lambda i: F.substr(edged, i, F.lit(k))))

    return F.flatten(F.filter(F.array(*map(of, range(1, order + 1))), lambda listed: listed.isNotNull()))


def _by_key(counts: DataFrame, purpose: str) -> DataFrame:
    """(key, lang, n) as one stored row per key, with its total and the place of that in a histogram."""
    return stored(
        counts.groupBy("key", "lang")
        .agg(F.sum("n").alias("n"))
        .groupBy("key")
        .agg(F.sum("n").alias("total"), F.collect_list(F.struct("lang", "n")).alias("langs"))
        .withColumn("step", F.floor(F.log2("total") * STEPS).cast("int")),
        purpose,
    )


def _most_frequent(keys: DataFrame, capacity: int) -> list:
    """The most frequent keys, as many whole steps of the histogram as fit the capacity."""
    steps = keys.groupBy("step").agg(F.sum(F.size("langs")).alias("pairs")).collect()
    cut, held = None, 0
    for row in sorted(steps, key=lambda r: -r["step"]):
        held += row["pairs"]
        if held > capacity:
            break
        cut = row["step"]
    return [] if cut is None else keys.filter(F.col("step") >= cut).select("key", "langs").collect()


def _scores(rows: list, totals: dict[str, int], names: list[str]) -> tuple[list[str], np.ndarray]:
    """Keys in order and their log frequencies by language, in thousandths and smoothed by a half."""
    rows = sorted(rows, key=lambda r: r["key"])
    place = {name: i for i, name in enumerate(names)}
    seen = np.zeros((len(rows), len(names)))
    for i, row in enumerate(rows):
        for lang, n in row["langs"]:
            seen[i, place[lang]] = n
    whole = np.array([totals.get(name, 0) for name in names], float)
    logs = np.log((seen + 0.5) / (whole + 0.5 * max(1, len(rows))))
    return [r["key"] for r in rows], np.rint(1000 * logs).astype(np.int32)


def learn(docs: DataFrame, fit: Fit = Fit(), text: str = "text", lang: str = "lang") -> bytes:
    """The model of all these texts, as the bytes of an Arrow table of bounded size.

    Rows without text or language teach nothing. Words are counted over all rows, with partial
    sums before the shuffle, and grams over the counted words. The driver sees histograms of the
    counts, one total per language and gram length, and the model.
    """
    told = docs.filter(docs[text].isNotNull() & docs[lang].isNotNull()).select(
        docs[lang].cast("string").alias("lang"), F.explode(_tokens(docs[text])).alias("key")
    )
    words = _by_key(told.filter("key != ''").groupBy("key", "lang").agg(F.count(F.lit(1)).alias("n")), "language-words")
    pairs = words.select("key", F.explode("langs").alias("l")).select("key", F.col("l.lang"), F.col("l.n"))
    grams = _by_key(pairs.select(F.explode(_grams(F.col("key"), fit.order)).alias("key"), "lang", "n"), "language-grams")
    totals = {(r["lang"], 0): r["n"] for r in pairs.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    lengths = grams.select(F.length("key").alias("k"), F.explode("langs").alias("l"))
    for r in lengths.groupBy("k", "l.lang").agg(F.sum("l.n").alias("n")).collect():
        totals[r["lang"], r["k"]] = r["n"]
    # A tie is won by the language with more words.
    names = sorted({name for name, _ in totals}, key=lambda name: (-totals[name, 0], name))
    held = _most_frequent(grams, fit.grams)
    tables = [_scores(_most_frequent(words, fit.words), {n: totals[n, 0] for n in names}, names)]
    for k in range(1, fit.order + 1):
        tables.append(_scores([r for r in held if len(r["key"]) == k], {n: totals.get((n, k), 0) for n in names}, names))
    table = pa.table(
        {
            "kind": pa.array(np.repeat(np.arange(len(tables), dtype=np.int8), [len(t[0]) for t in tables])),
            "key": pa.array([key for keys, _ in tables for key in keys], pa.string()),
            **{f"s{i}": np.concatenate([scores[:, i] for _, scores in tables]) for i in range(len(names))},
        }
    ).replace_schema_metadata({b"langs": "\x00".join(names).encode(), b"order": str(fit.order).encode()})
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


class Model:
    """A learned model, as a worker holds it."""

    _read: dict[str, Model] = {}

    @classmethod
    def of(cls, content: bytes) -> Model:
        key = hashlib.sha256(content).hexdigest()
        if key not in cls._read:
            cls._read.clear()
            cls._read[key] = cls(content)
        return cls._read[key]

    def __init__(self, content: bytes):
        table = pa.ipc.open_stream(content).read_all()
        names = table.schema.metadata[b"langs"].decode()
        self.langs = names.split("\x00") if table.num_columns > 2 else []
        self.order = int(table.schema.metadata[b"order"])
        kind = table["kind"].to_numpy()
        scores = np.column_stack([table[f"s{i}"].to_numpy() for i in range(len(self.langs))] or [np.empty((len(kind), 0))])
        keys = table["key"].combine_chunks()
        self.words = keys.filter(pa.array(kind == 0))
        self.word_scores = scores[kind == 0].astype(np.int64)
        # Grams are named by their parts: the characters, then the gram without its last one.
        self.codes = np.array(sorted({ord(c) for gram in keys.filter(pa.array(kind > 0)).to_pylist() for c in gram}), np.int64)
        self.grams: list[tuple[np.ndarray, np.ndarray]] = []
        for k in range(1, self.order + 1):
            listed = keys.filter(pa.array(kind == k)).to_pylist()
            points = np.frombuffer("".join(listed).encode("utf-32-le"), np.uint32).astype(np.int64).reshape(-1, k)
            places = np.searchsorted(self.codes, points)
            named = places[:, 0]
            for j in range(1, k):
                named = self._named(j, named) * len(self.codes) + places[:, j]
            # A gram whose beginning was not held would have no name; beginnings are never rarer.
            by_name = np.argsort(named, kind="stable")
            self.grams.append((named[by_name], scores[kind == k][by_name].astype(np.int64)))

    def _named(self, k: int, keys: np.ndarray) -> np.ndarray:
        """Places of these grams of ``k`` characters among those held, -1 for others."""
        held = self.grams[k - 1][0]
        if not len(held):
            return np.full(len(keys), -1, np.int64)
        at = np.minimum(np.searchsorted(held, keys), len(held) - 1)
        return np.where(held[at] == keys, at, -1)

    def _backed_off(self, words: list[str]) -> np.ndarray:
        """Scores of unseen words: the mean over the known grams of the greatest length that has one."""
        out = np.zeros((len(words), len(self.langs)), np.int64)
        if not words or not len(self.codes):
            return out
        sizes = np.fromiter((len(w) + 2 for w in words), np.int64, len(words))
        points = np.frombuffer("".join(f"{EDGE}{w}{EDGE}" for w in words).encode("utf-32-le"), np.uint32).astype(np.int64)
        at = np.minimum(np.searchsorted(self.codes, points), len(self.codes) - 1)
        single = np.where(self.codes[at] == points, at, -1)
        owner = np.repeat(np.arange(len(words)), sizes)
        named = [np.where(single >= 0, self._named(1, single), -1)]
        for k in range(2, self.order + 1):
            before, last = named[-1][:-1], single[k - 1 :]
            within = (before >= 0) & (last >= 0) & (owner[: len(last)] == owner[k - 1 :])
            named.append(np.where(within, self._named(k, before * len(self.codes) + last), -1))
        open_words = np.ones(len(words), bool)
        for k in range(self.order, 0, -1):
            found = np.flatnonzero((named[k - 1] >= 0) & open_words[owner[: len(named[k - 1])]])
            of = owner[found]
            counts = np.bincount(of, minlength=len(words))
            rows = self.grams[k - 1][1][named[k - 1][found]]
            for i in range(len(self.langs)):
                total = np.bincount(of, rows[:, i], len(words))
                out[:, i] += np.rint(total / np.maximum(counts, 1)).astype(np.int64)
            open_words &= counts == 0
        return out

    def judge(self, words: pa.Array, starts: np.ndarray) -> tuple[list[str], np.ndarray]:
        """Language and score of texts whose words follow each other in ``words`` from ``starts``."""
        n = len(starts) - 1
        if not self.langs:
            return [UNKNOWN] * n, np.zeros(n)
        coded = words.dictionary_encode()
        kinds, at = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False)
        place = pc.fill_null(pc.index_in(kinds, value_set=self.words), -1).to_numpy(zero_copy_only=False)
        empty = pc.equal(kinds, "").to_numpy(zero_copy_only=False)
        scores = np.zeros((len(kinds), len(self.langs)), np.int64)
        scores[place >= 0] = self.word_scores[place[place >= 0]]
        unseen = np.flatnonzero((place < 0) & ~empty)
        scores[unseen] = self._backed_off(kinds.take(pa.array(unseen)).to_pylist())

        def summed(by_kind: np.ndarray) -> np.ndarray:
            ends = np.concatenate([[0], np.cumsum(by_kind[at])])
            return ends[starts[1:]] - ends[starts[:-1]]

        sums = np.column_stack([summed(scores[:, i]) for i in range(len(self.langs))])
        counted = np.maximum(summed((~empty).astype(np.int64)), 1)
        best = sums.argmax(axis=1)
        top = sums[np.arange(n), best]
        share = 1 / np.exp((sums - top[:, None]) / (1000 * counted[:, None])).sum(axis=1)
        return [self.langs[i] for i in best.tolist()], share


def identify(docs: DataFrame, model: bytes, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row: key, ``lang_pred``, ``score``.

    A word the model knows counts with the logarithm of its frequency in each language. Any other
    counts with the mean over its grams of four characters that the model knows, or if there is none
    of three, of two, of one. The language with the greatest sum is given; equal sums go to the
    language with more training words. The score is its share when means per word are put
    through a softmax, between 0 and 1.

    A null text and one without a letter is ``und`` with score 0, and so is every text where the model
    was learned from nothing. Repeated rows give the same, null keys are kept, an empty table gives
    no rows, other columns are ignored. Only the text decides. Whole texts are read; rows are
    independent, so nothing is shuffled. The model, bounded by its fit, is broadcast.
    """
    spark = docs.sparkSession
    ship_code(spark)
    shared = spark.sparkContext.broadcast(model)

    def run(batches):
        known = Model.of(shared.value)
        for batch in batches:
            listed, lettered = batch["_words"], batch["_lettered"].to_pylist()
            offsets, flat = listed.offsets.to_numpy(), listed.values
            langs: list[str] = []
            shares: list[np.ndarray] = []
            first = 0
            while first < len(listed):
                last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + CHUNK_WORDS, side="right")) - 1)
                last = min(last, len(listed))
                part = flat.slice(offsets[first], offsets[last] - offsets[first])
                found, share = known.judge(part, offsets[first : last + 1] - offsets[first])
                langs += found
                shares.append(share)
                first = last
            shown = [lang if has else UNKNOWN for lang, has in zip(langs, lettered, strict=True)]
            score = np.where(np.array(lettered, bool), np.concatenate([np.empty(0), *shares]), 0.0)
            yield pa.RecordBatch.from_arrays([batch["_key"], pa.array(shown, pa.string()), pa.array(score)], names=[key, "lang_pred", "score"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(
        docs[key].alias("_key"),
        _tokens(docs[text]).alias("_words"),
        text_of(docs[text]).rlike(r"\p{L}").alias("_lettered"),
    ).mapInArrow(run, f"`{key}` {kind}, lang_pred string, score double")


def fold(key: Column, folds: int = 4) -> Column:
    """Part of the rows a key belongs to, by the checksum of its text; null for a null key."""
    return F.crc32(key.cast("string")) % folds


def op11_language_id(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    model = learn(docs.filter(fold(F.col("doc_id")) != 2))
    return identify(docs, model).select(
        "doc_id", F.coalesce(fold(F.col("doc_id")) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score"
    )
