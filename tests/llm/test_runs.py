import hashlib
import random
import zlib

import numpy as np
from brute import WORD
from helpers import LONG, documents, prose
from hypothesis import given, settings
from hypothesis import strategies as st
from wavemeter.llm.runs import diagonal_runs, op12_periodic_runs, periodic_runs


def plain_runs(t):
    """Every lag, every place; a stretch counts if no shorter period fits it."""
    n, out = len(t), set()
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if t[i] != t[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and t[i] == t[i + q]:
                i += 1
            length = i - s + q
            whole = t[s : s + length]
            if length >= max(6, 4 * q) and not any(whole[d:] == whole[: length - d] for d in range(1, q)):
                out.add((s, length, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_row(doc_id, text):
    ws = WORD.findall(text or "")
    n, h = len(ws), zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        ws = [w if i < a else ws[a + (i - a) % p] for i, w in enumerate(ws)]
    runs = plain_runs(ws)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
    digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (
        doc_id,
        len(runs),
        *(best or (None,) * 3),
        1000 * best[1] // best[2] if best else None,
        digest("".join(f"{s},{length},{q}\n" for s, length, q in runs)),
        digest(" ".join(w for i, w in enumerate(ws) if i not in gone)),
    )


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=9), st.integers(1, 7)), max_size=8))
def test_runs_are_those_of_every_lag(parts):
    tokens = [x for unit, times in parts for x in unit * times]
    assert diagonal_runs(np.array(tokens, np.int64)) == plain_runs(tokens)


def test_long_periods_whose_grams_recur_inside():
    rnd = random.Random(5)
    for size in (16, 33, 64, 100):
        for _ in range(10):
            unit = [rnd.randrange(2) for _ in range(size)]
            tokens = [rnd.randrange(2) for _ in range(20)] + unit * 4 + unit[: size // 2] + [rnd.randrange(2) for _ in range(20)]
            assert diagonal_runs(np.array(tokens, np.int64)) == plain_runs(tokens)


def test_frames(spark):
    rows = [
        (1, None),
        (2, ""),
        (3, " \n\t "),
        (4, "a a a a a a"),
        (4, "a a a a a a"),
        (5, "a a a a a"),
        (6, "x y z " * 4),
        (7, LONG),
        (8, "no no yes " * 3 + "stop stop stop stop stop stop stop"),
        (None, "b c b c b c b c d"),
    ]
    out = {}
    for r in periodic_runs(documents(spark, rows)).collect():
        out.setdefault(r["doc_id"], []).append((r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]))
    empty = [(0, [], "")]
    assert out[1] == out[2] == out[3] == empty
    assert out[4] == [(6, [(0, 6, 1)], "a")] * 2
    assert out[5] == [(5, [], "a a a a a")]
    assert out[6] == [(8, [(0, 8, 2)], "x y z")]
    assert out[7] == [(160_000, [(0, 160_000, 4)], "alpha beta gamma delta.")]
    assert out[8][0][1] == [(9, 7, 1)]
    assert out[None] == [(9, [(0, 8, 2)], "b c d")]
    assert periodic_runs(documents(spark, [])).count() == 0


def test_query_equals_plain_version(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    got = {tuple(r[n] for n in names) for r in op12_periodic_runs(spark, sf).collect()}
    assert got == {plain_row(d["doc_id"], d["text"]) for d in docs}
    assert any(r[1] for r in got)


def test_query_plants_by_checksum(spark, tmp_path):
    rows = [(i, prose(i, i % 60) if i % 7 else None) for i in range(400)] + [(None, "a b")]
    documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: tuple(r)[1:] for r in op12_periodic_runs(spark, str(tmp_path)).collect()}
    for doc_id, text in rows[:-1]:
        assert got[doc_id] == plain_row(doc_id, text)[1:]
    assert got[None][0] == 0
