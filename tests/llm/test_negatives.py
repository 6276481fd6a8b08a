import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from wavemeter.llm.negatives import Lists, Mining, hard_negatives, op13_hard_negatives, quantised
from wavemeter.llm.registry import ORACLES

KIND = "vec_id long, embedding array<double>, label int, anchor long, score double, block string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 2.0, "x") for r in rows], KIND)


def plain(rows, mining):
    rows = {
        (i, tuple(v), label)
        for i, v, label in rows
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    }
    whole = [(i, [int(256 * x // 1) if abs(x) < 2**40 else 256 * int(x) for x in v], label, v) for i, v, label in rows]
    out = []
    for i, a, label, v in whole:
        if i % mining.every:
            continue
        scored = sorted(
            ((-sum(x * y for x, y in zip(a, b, strict=False)), j, other) for j, b, other, w in whole if j != i),
            key=lambda s: s[:2],
        )
        for score, j, _ in [s for s in scored if s[2] == label][: mining.positives]:
            low, high = mining.low[0] * -score, mining.high[0] * -score
            inside = [s for s in scored if s[2] != label and low <= mining.low[1] * -s[0] and mining.high[1] * -s[0] <= high]
            out += [(i, j, n, s[1], -score, -s[0]) for n, s in enumerate(inside[: mining.negatives], 1)]
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 400), st.integers(1, 6), st.integers(0, 10**6), st.booleans())
def test_threshold_stops_with_the_right_rows(n, width, seed, tied):
    rnd = np.random.default_rng(seed)
    rows = rnd.integers(-2, 3, (n, width)) / 2 if tied else rnd.normal(size=(n, width))
    ids = rnd.permutation(n)
    lists = Lists(ids.tolist(), [0] * n, [str(x % 3) for x in ids], list(rows.astype(float)))
    anchor = quantised(rnd.normal(size=(1, width)))[0]
    allowed = rnd.random(n) < 0.8
    scores = quantised(rows.astype(float)) @ anchor
    windows = [(None, None), (int(scores.mean()), int(scores.max() * 0.9)), (0, 0)]
    for (low, high), found in zip(windows, lists.first(anchor, allowed, windows, 3), strict=True):
        inside = [p for p in range(n) if allowed[p] and (low is None or low <= scores[p]) and (high is None or scores[p] <= high)]
        want = sorted(inside, key=lambda p: (-scores[p], ids[p]))[:3]
        assert [(s, ids[p]) for s, p in found] == [(scores[p], ids[p]) for p in want]


@pytest.mark.parametrize("mining", [Mining(every=3, block_rows=20, block_anchors=7), Mining(every=5)])
def test_blocks_equal_brute_force(spark, mining):
    rnd = np.random.default_rng(4)
    rows = [(i, (rnd.normal(size=8) + (i % 2)).tolist(), int(rnd.integers(0, 4))) for i in range(150)]
    # A third of all rows are one vector, under many ids.
    rows += [(200 + i, [0.5] * 8, i % 2) for i in range(75)]
    assert got(hard_negatives(frame(spark, rows), mining)) == plain(rows, mining)


def test_defined_cases(spark):
    mining = Mining(every=5, low=(0, 1), high=(2, 1))
    rows = [
        (0, [1.0, 2.0], 1),
        (0, [1.0, 2.0], 1),  # counts once
        (5, [1.0], 1),  # shorter
        (1, [1.0, 2.0, 9.0], 1),  # longer
        (2, None, 1),
        (3, [1.0, None], 1),
        (4, [float("nan"), 1.0], 1),
        (6, [float("inf"), 1.0], 2),
        (7, [1.0, 1.0], None),
        (None, [1.0, 2.0], 1),
        (8, [0.3, 0.3], 2),
        (10, [], 2),
        (15, [0.0, 0.0], 2),
        (20, [3.0, -1.0], 3),
    ]
    assert got(hard_negatives(frame(spark, rows), mining)) == plain(rows, mining)
    assert hard_negatives(frame(spark, []), mining).count() == 0


def test_large_components_are_exact(spark):
    mining = Mining(every=5, low=(0, 1), high=(2, 1))
    rows = [(0, [2.0**20 + 1 / 256, 3.0], 1), (1, [2.0**20, 5.0], 1), (2, [2.0**20 + 1 / 256, 1.0], 2), (3, [2.0**19, 2.0**18], 2)]
    rows += [(5, [2.0**24, 1.0], 4), (6, [2.0**20 + 1 / 256, -(2.0**20)], 4), (7, [2.0**21 + 1 / 256, 1.0], 5)]
    assert got(hard_negatives(frame(spark, rows), mining)) == plain(rows, mining)


def test_scores_beyond_64_bits(spark):
    rows = [(0, [1e300], 1), (1, [1e299], 1), (2, [5e298], 2), (3, [9e299], 2)]
    # All scores are the end of the range, so no other label lies below the positive.
    assert got(hard_negatives(frame(spark, rows), Mining())) == []
    assert got(hard_negatives(frame(spark, rows), Mining(high=(1, 1))))[0] == (0, 1, 1, 2, 2**63 - 1, 2**63 - 1)


def test_query_equals_sql(spark, sf):
    from tools.oracle import compare

    assert compare(op13_hard_negatives(spark, sf), ORACLES["op13_hard_negatives"], sf) is None


def test_anchors_meet_blocks_not_pairs(spark, sf):
    """No cross join, no nested loops."""
    frame_ = spark.read.parquet(f"{sf}/embeddings.parquet").withColumn("label", F.col("label"))
    text = hard_negatives(frame_)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
