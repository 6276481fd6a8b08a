"""Byte-level byte-pair encoding and decoding by DuckDB queries inside each task."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StructField, StructType

from wavemeter.llm.expressions import ship_code
from wavemeter.llm.workers import hold

# Texts of so many bytes are taken together, one longer text alone.
CHUNK_BYTES = 1_000_000
# Encoded words a worker remembers before it forgets rare ones (some 150 bytes each); a matter of speed alone.
KNOWN_WORDS = 150_000
# The same for the query alone, whose workers hold nothing else.
QUERY_WORDS = 600_000
# Words that one query encodes; bounds the rows of its rounds.
WORDS_AT_ONCE = 25_000
# Longer words go one by one through the query that merges many places in a round.
SHORT_WORD = 64
LONG_ROUNDS = 8

# One round of every word still open: neighbours meet the merge table, and the leftmost pair of least
# rank becomes one row. A key is the word's number and the place. A word without a pair gives no
# more rows, and its last ones are its ids.
ENCODE_SHORT = f"""
with recursive step(key, tok, round) as (
    select word::bigint * {2 * SHORT_WORD} + pos, tok, 0 from symbols
    union all
    (with linked as (
        select key, tok, lead(tok) over w as next_tok, lead(key) over w as next_key
        from step window w as (order by key)
    ), pairs as (
        select l.key, l.next_key, m.merged, l.key // {2 * SHORT_WORD} as word,
               m.merged::bigint * {2 * SHORT_WORD} + l.key % {2 * SHORT_WORD} as cost
        from linked l join merges m on l.tok = m.lft and l.next_tok = m.rgt
        where l.key // {2 * SHORT_WORD} = l.next_key // {2 * SHORT_WORD}
    ), best as (
        select word, min(cost) as cost from pairs group by word
    ), cut as (
        select p.key, p.next_key, p.merged from pairs p join best b on p.word = b.word and p.cost = b.cost
    )
    select s.key, coalesce(c.merged, s.tok), s.round + 1
    from step s join best b on s.key // {2 * SHORT_WORD} = b.word left join cut c on s.key = c.key
    where not exists (select 1 from cut d where d.next_key = s.key))
), last as (
    select key // {2 * SHORT_WORD} as word, max(round) as round from step group by all
)
select s.key, s.tok from step s join last l on s.key // {2 * SHORT_WORD} = l.word and s.round = l.round
"""

# The same for one long word, a few rounds at a time. If no pair with the merged token ranks below
# it (it is calm), its other places, every second of those that overlap, merge in the same round:
# one after another they would be the next leftmost ones.
ENCODE_LONG = f"""
with recursive step(pos, tok, round) as (
    select pos, tok, 0 from symbols
    union all
    (with linked as (
        select *, lead(tok) over (order by pos) as next_tok from step
    ), ranked as (
        select l.*, m.merged, m.calm from linked l
        left join merges m on l.tok = m.lft and l.next_tok = m.rgt
    ), best as (
        select arg_min(struct_pack(pos := pos, merged := merged, calm := calm),
                       merged::bigint * 4294967296 + pos) as b
        from ranked where merged is not null having count(*) > 0
    ), hits as (
        select r.*, b, r.merged is not distinct from b.merged as hit,
               row_number() over (order by r.pos) as n from ranked r, best where r.round < {LONG_ROUNDS}
    ), runs as (
        select *, n - row_number() over (partition by hit order by pos) as run from hits
    ), taken as (
        select *, hit and (pos = b.pos or b.calm
                           and row_number() over (partition by hit, run order by pos) % 2 = 1) as take
        from runs
    ), kept as (
        select *, lag(take) over (order by pos) as gone from taken
    )
    select pos, case when take then merged else tok end, round + 1 from kept where gone is not true)
)
select tok, max(round) over () as rounds from step
qualify round = max(round) over () order by pos
"""

DECODE = """
select t.row, unhex(string_agg(v.hex, '' order by t.pos)) as bytes
from tokens t join vocabulary v on t.tok = v.tok group by t.row
"""


def read_ranks(path: str) -> bytes:
    """The content of a rank file: base64 of the bytes and the rank, a token per line."""
    with open(path, "rb") as file:
        return file.read()


class _Numbered(dict):
    """Words by number, in the order in which they are first asked for."""

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        return number


class Coder:
    """The vocabulary of one worker: merge table in DuckDB, and the words already encoded."""

    _made: dict[str, Coder] = {}

    @classmethod
    def of(cls, content: bytes, pattern: str, most: int = KNOWN_WORDS) -> Coder:
        key = hashlib.sha256(content + pattern.encode()).hexdigest()
        hold("coder", cls._drop)
        if key not in cls._made:
            cls._drop()
            cls._made[key] = cls(content, pattern)
        cls._made[key].most = most
        return cls._made[key]

    @classmethod
    def _drop(cls) -> None:
        for coder in cls._made.values():
            coder.db.close()
        cls._made.clear()

    def __init__(self, content: bytes, pattern: str, most: int = KNOWN_WORDS):
        import duckdb
        import regex

        lines = (line.split() for line in content.splitlines() if line)
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in lines}
        self.bytes = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        self.pattern = regex.compile(pattern)
        self.most = most
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "150MB"})
        self.tables: set[str] = set()
        self.known = _Numbered()
        self.ids = np.empty(0, np.int32)
        self.lengths = np.empty(0, np.int64)
        self.seen = np.empty(0, np.int64)

    def _table(self, name: str, **columns) -> None:
        self.db.register("given", pa.table(columns))
        self.db.execute(f"create or replace table {name} as select * from given")
        self.db.unregister("given")

    def _need(self, name: str) -> None:
        """Make a table of the vocabulary when it is first used."""
        if name in self.tables:
            return
        self.tables.add(name)
        if name == "vocabulary":
            tokens = np.fromiter(self.ranks.values(), np.int32, len(self.ranks))
            self._table(name, tok=tokens, hex=[token.hex() for token in self.ranks])
            return
        merges = [
            (self.ranks[token[:i]], self.ranks[token[i:]], rank)
            for token, rank in self.ranks.items()
            for i in range(1, len(token))
            if token[:i] in self.ranks and token[i:] in self.ranks
        ]
        lft, rgt, merged = (np.array(x, np.int32) for x in zip(*merges, strict=True))
        restless = np.union1d(lft[lft > merged], rgt[rgt > merged])
        self._table(name, lft=lft, rgt=rgt, merged=merged, calm=~np.isin(merged, restless))

    def _forget(self) -> None:
        """Keep the words seen most often, half of what is remembered at most; ties go to earlier ones."""
        often = np.argsort(-self.seen, kind="stable")[: self.most // 2]
        kept = np.sort(often[self.seen[often] > 1])
        words = list(self.known)
        ends = np.cumsum(self.lengths)
        self.ids = np.concatenate([np.empty(0, np.int32), *(self.ids[ends[i] - self.lengths[i] : ends[i]] for i in kept)])
        self.lengths = self.lengths[kept]
        self.known = _Numbered((words[i], n) for n, i in enumerate(kept.tolist()))
        # Halved, so that what was frequent long ago gives way in time.
        self.seen = self.seen[kept] // 2

    def _symbols(self, words: list[bytes]) -> None:
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        flat = np.frombuffer(b"".join(words), np.uint8)
        self._table(
            "symbols",
            word=np.repeat(np.arange(len(words), dtype=np.int32), lengths),
            pos=(np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)).astype(np.int32),
            tok=self.bytes[flat],
        )

    def _short(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of these words one after another, and how many each has."""
        self._need("merges")
        self._symbols(words)
        found = self.db.sql(ENCODE_SHORT).to_arrow_table()
        key = found["key"].to_numpy()
        order = np.argsort(key)
        counts = np.bincount(key // (2 * SHORT_WORD), minlength=len(words))
        return found["tok"].to_numpy()[order].astype(np.int32), counts

    def _long(self, word: bytes) -> np.ndarray:
        self._need("merges")
        self._symbols([word])
        while True:
            found = self.db.sql(ENCODE_LONG).to_arrow_table()
            tokens = found["tok"].to_numpy()
            if found["rounds"][0].as_py() < LONG_ROUNDS:
                return np.array(tokens, np.int32)
            self._table("symbols", pos=np.arange(len(tokens), dtype=np.int32), tok=tokens)

    def _learn(self, words: list[str]) -> None:
        """Encode new words and append their ids to those known."""
        raw = [word.encode() for word in words]
        whole = [self.ranks.get(word, -1) for word in raw]
        lengths = np.ones(len(raw), np.int64)
        pieces: dict[int, np.ndarray] = {}
        short = [i for i, word in enumerate(raw) if whole[i] < 0 and len(word) <= SHORT_WORD]
        for start in range(0, len(short), WORDS_AT_ONCE):
            some = short[start : start + WORDS_AT_ONCE]
            ids, counts = self._short([raw[i] for i in some])
            lengths[some] = counts
            pieces[start] = ids
        long = {i: self._long(word) for i, word in enumerate(raw) if whole[i] < 0 and len(word) > SHORT_WORD}
        for i, ids in long.items():
            lengths[i] = len(ids)
        flat = np.empty(int(lengths.sum()), np.int32)
        first = np.cumsum(lengths) - lengths
        single = np.array(whole, np.int64)
        flat[first[single >= 0]] = single[single >= 0]
        if short:
            counts = lengths[short]
            at = np.repeat(first[short] - (np.cumsum(counts) - counts), counts)
            flat[at + np.arange(len(at))] = np.concatenate(list(pieces.values()))
        for i, ids in long.items():
            flat[first[i] : first[i] + len(ids)] = ids
        self.ids, self.lengths = np.concatenate([self.ids, flat]), np.concatenate([self.lengths, lengths])
        self.seen = np.concatenate([self.seen, np.zeros(len(raw), np.int64)])

    def encode(self, texts: list[str]) -> pa.ListArray:
        if len(self.known) > self.most:
            self._forget()
        before, number, counts, seen = len(self.known), self.known.__getitem__, [], []
        for text in texts:
            pieces = self.pattern.findall(text)
            counts.append(len(pieces))
            seen.append(np.fromiter(map(number, pieces), np.int64, len(pieces)))
        if len(self.known) > before:
            self._learn(list(self.known)[before:])
        at = np.concatenate([np.empty(0, np.int64), *seen])
        self.seen += np.bincount(at, minlength=len(self.seen))
        lengths = self.lengths[at]
        ends = np.cumsum(lengths)
        starts = (np.cumsum(self.lengths) - self.lengths)[at]
        total = int(ends[-1]) if len(ends) else 0
        flat = self.ids[np.repeat(starts - (ends - lengths), lengths) + np.arange(total)]
        words = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
        offsets = np.concatenate([[0], ends])[words].astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int32()))

    def decode(self, ids: pa.ListArray) -> pa.Array:
        self._need("vocabulary")
        offsets = np.asarray(ids.offsets, np.int64)
        lengths = np.diff(offsets)
        flat = np.asarray(ids.flatten(), np.int32)
        row = np.repeat(np.arange(len(ids), dtype=np.int32), lengths)
        self._table(
            "tokens", row=row, tok=flat,
            pos=(np.arange(len(flat)) - (offsets[:-1] - offsets[0])[row]).astype(np.int32),
        )
        found = self.db.sql(DECODE).to_arrow_table()
        out: list[bytes] = [b""] * len(ids)
        for n, text in zip(found["row"].to_pylist(), found["bytes"].to_pylist(), strict=True):
            out[n] = text
        return pa.array(out, pa.binary())


def _chunks(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Slices of rows whose sizes sum to ``most`` or one row."""
    start = total = 0
    for i, size in enumerate(sizes.tolist()):
        if i > start and total + size > most:
            yield start, i - start
            start, total = i, 0
        total += size
    if len(sizes) > start:
        yield start, len(sizes) - start


def _sizes(column: pa.Array) -> np.ndarray:
    import pyarrow.compute as pc

    kind = pc.binary_length if pa.types.is_binary(column.type) or pa.types.is_string(column.type) else pc.list_value_length
    return np.asarray(pc.fill_null(kind(column), 0), np.int64)


def encode(
    docs: DataFrame, ranks: str, pattern: str, text: str = "text", into: str = "ids",
    known_words: int = KNOWN_WORDS, back: str | None = None,
) -> DataFrame:
    """Replace the text of every row by its token ids ``into``; other columns pass through.

    Every match of ``pattern`` is encoded on its own: a match that is a token is that token, any
    other has its leftmost pair of least rank contracted until none is left. There are no special
    tokens, so their strings are text. Null and empty texts have no ids, repeated rows the same
    ones, an empty table stays empty. The rank file is read by the driver and sent along (it does
    not grow with the data); a column named ``into`` is replaced. A worker remembers ``known_words``
    at most; the ids do not depend on it. With ``back`` a column of that name gets the bytes that
    :func:`decode` would give for the ids, read back by the same worker.
    """
    ship_code(docs.sparkSession)
    content = read_ranks(ranks)
    rest = [c for c in docs.columns if c not in (text, into, back)]
    schema = StructType([*(docs.schema[c] for c in rest), StructField(into, ArrayType(IntegerType()))])
    if back:
        schema = schema.add(back, BinaryType())

    def run(batches):
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            for start, n in _chunks(_sizes(texts), CHUNK_BYTES):
                part = batch.slice(start, n)
                coder = Coder.of(content, pattern, known_words)
                ids = coder.encode([t or "" for t in texts.slice(start, n).to_pylist()])
                found = [ids, coder.decode(ids)] if back else [ids]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *found], names=schema.names)

    return docs.select(*rest, docs[text].cast("string").alias("_text")).mapInArrow(run, schema)


def decode(encoded: DataFrame, ranks: str, pattern: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """Replace ids by the bytes they stand for, as binary; other columns pass through.

    Null or empty ids give no bytes; an id the vocabulary lacks is an error of the input.
    """
    ship_code(encoded.sparkSession)
    content = read_ranks(ranks)
    rest = [c for c in encoded.columns if c not in (ids, into)]
    schema = StructType([*(encoded.schema[c] for c in rest), StructField(into, BinaryType())])

    def run(batches):
        for batch in batches:
            column = batch.column(batch.num_columns - 1)
            for start, n in _chunks(4 * _sizes(column), CHUNK_BYTES):
                part = batch.slice(start, n)
                raw = Coder.of(content, pattern).decode(column.slice(start, n))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], raw], names=[*rest, into])

    whole = F.coalesce(encoded[ids].cast("array<int>"), F.array().cast("array<int>"))
    return encoded.select(*rest, whole.alias("_ids")).mapInArrow(run, schema)


def digests(docs: DataFrame, ranks: str, pattern: str, known_words: int = KNOWN_WORDS) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, and decoded_sha256 of the bytes read back from the ids."""
    both = encode(docs.select("doc_id", "text"), ranks, pattern, known_words=known_words, back="decoded")
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op5_byte_bpe(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return digests(docs, ranks, public_tokenizers.PATTERN, known_words=QUERY_WORDS)
