import numpy as np
import pytest

from brute import jaccard_components
from helpers import documents, edited, prose
from wavemeter.llm.jaccard import Join, index_rows, jaccard_join, op8_jaccard_join, same_components
from wavemeter.llm.shingles import shingle_set


def compare(spark, rows, join=Join()):
    out = jaccard_join(documents(spark, rows), join).collect()
    expected = jaccard_components([r for r in rows if r[0] is not None])
    assert len(out) == len(rows)
    for r in out:
        if r["doc_id"] is not None:
            assert (r["n_shingles"], r["component_id"]) == expected[r["doc_id"]], r
        else:
            assert r["component_id"] is None


def families(seed, sizes):
    rows, n = [], 0
    for f, (words, members, share) in enumerate(sizes):
        text = prose(f"{seed}{f}", words)
        for m in range(members):
            rows.append((n * 13 % 1009, edited(text, f"{seed}{f}{m}", share if m else 0)))
            n += 1
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_borderline_families(spark, seed):
    sizes = [(60, 10, 0.02), (200, 12, 0.03), (300, 8, 0.05), (31, 8, 0.02), (900, 5, 0.025), (12, 6, 0.05), (7, 5, 0.1)]
    compare(spark, families(seed, sizes))


def test_small_empty_and_odd(spark):
    rows = [
        (1, None), (2, ""), (3, " \n"), (4, "a b"), (5, "A B"), (6, "a b c d e"), (7, "a b c d e f"), (8, "a"), (None, "a b"),
        (9, "a b c d e f g h i"), (10, "a b c d e f g h"), (11, "a b c d e f g h"), (12, "x " * 5000), (13, "x " * 7),
    ]
    compare(spark, rows)
    compare(spark, [])


def test_copies_and_shared_line(spark):
    line = prose("line", 12)
    rows = [(n, prose(n, 40) + " " + line) for n in range(60)] + [(100 + n, prose("copy", 80)) for n in range(60)]
    rows += [(200 + n, edited(prose("near", 150), n, 0.01)) for n in range(40)]
    compare(spark, rows, Join(hot=3))


def test_long_texts(spark):
    text = prose("long", 20_000)
    compare(spark, [(1, text), (2, edited(text, 1, 0.01)), (3, edited(text, 2, 0.2)), (4, text + " tail")])


def test_repeated_keys_are_one_node(spark):
    x, y = prose("x", 60), prose("y", 60)
    out = jaccard_join(documents(spark, [(1, x), (1, y), (2, y), (3, x)])).collect()
    assert {r["component_id"] for r in out} == {1} and len(out) == 4
    z = x + " tail"
    out = jaccard_join(documents(spark, [(5, x), (5, y), (3, y), (6, z)])).collect()
    assert {r["component_id"] for r in out} == {3} and len(out) == 4


@pytest.mark.parametrize("noise", [0, 0.5, 1])
def test_every_link_is_probed(noise):
    """The pigeonhole itself: pairs just over the threshold meet, whatever else shares a signature."""
    rnd = np.random.default_rng(5)
    join = Join()
    for _ in range(500):
        n = int(rnd.integers(1, 300))
        both = rnd.integers(0, 2**63, n).astype(np.uint64)
        spare = int(rnd.integers(0, max(1, n // 3) + 1))
        left = int(rnd.integers(0, spare // 2 + 1))
        x = np.unique(np.concatenate([both, rnd.integers(0, 2**63, left).astype(np.uint64)]))
        y = np.unique(np.concatenate([both, rnd.integers(0, 2**63, spare - left).astype(np.uint64)]))
        if 4 * n < 3 * (len(x) + len(y) - n):
            continue
        opened = 0
        for values in (x, y):
            for band, (_, near, whole, _, lack) in enumerate(index_rows(values, join), len(values).bit_length() - 1):
                opened |= int(lack + (near[whole] >= 0).sum() > 0) << band
        indexed = {s for sigs, _, _, own, _ in index_rows(y, join, opened) if own for s in sigs.tolist()}
        met = False
        for sigs, near, whole, _, lack in index_rows(x, join, opened):
            shared = np.array([s in indexed for s in sigs.tolist()]) | (rnd.random(len(sigs)) < noise)
            held = np.where(shared, rnd.integers(2, 9, len(sigs)), 1)
            asked = lack + int((shared & whole).sum()) + len({*near[shared & (near >= 0)].tolist()})
            order = [i for i in np.argsort(held, kind="stable") if shared[i] and whole[i]]
            met |= any(int(sigs[i]) in indexed for i in order[: max(0, asked)])
        assert met, (len(x), len(y), n)


def test_shingles():
    assert len(shingle_set("a b c d")) == 1 and len(shingle_set("A b c d")) == 1
    assert (shingle_set("a\x0bb\x0cc d") == shingle_set("A B\tC\rD")).all()
    assert len(shingle_set("a\x1cb \xa0 c")) == 1 and len(shingle_set(None)) == 0


def test_same_components_keeps_one(spark):
    docs = documents(spark, [(2, prose(1, 60)), (1, prose(1, 60)), (3, "z"), (None, "q"), (4, None)])
    kept = same_components(docs, jaccard_join(docs))
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {1, 3, 4, None}


def test_driver_table(spark, sf):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    expected = jaccard_components(docs)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in op8_jaccard_join(spark, sf).collect()}
    assert got == expected
