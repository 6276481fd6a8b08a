import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wavemeter.functions.quantiles import exact_percentile
from wavemeter.operators.chosen import aggregate_by_name
from wavemeter.operators.enrich import WIDE_KEYS, wide_agg


def test_hot_groups_are_exact(spark):
    """One key holds most rows, another many ties, another is small."""
    rng = np.random.default_rng(3)
    groups = {
        "hot": rng.normal(size=5000).round(3),
        "ties": np.repeat([1.0, 2.0, 3.0], 700),
        "small": rng.normal(size=40),
        None: rng.normal(size=900),
    }
    rows = [(k, float(v)) for k, values in groups.items() for v in values]
    df = spark.createDataFrame(rows + [("hot", None)], "k string, v double").repartition(5)
    for p in (0.0, 0.5, 0.9, 0.999, 1.0):
        got = {
            r["k"]: r["q"]
            for r in exact_percentile(df, ["k"], "v", p, "q", ranges=8).collect()
        }
        for key, values in groups.items():
            assert got[key] == pytest.approx(np.percentile(values, p * 100), abs=1e-9)


@settings(max_examples=8, deadline=None)
@given(
    values=st.lists(st.floats(allow_nan=False, allow_infinity=False, width=32), min_size=1, max_size=60),
    p=st.sampled_from([0.0, 0.25, 0.5, 0.95, 1.0]),
    ranges=st.sampled_from([1, 2, 4096]),
)
def test_any_number_of_ranges_gives_the_same(spark, values, p, ranges):
    df = spark.createDataFrame([("k", float(v)) for v in values], "k string, v double")
    got = exact_percentile(df, ["k"], "v", p, "q", ranges=ranges).first()["q"]
    assert got == pytest.approx(np.percentile(values, p * 100), rel=1e-9, abs=1e-300)


def test_values_hard_to_tell_apart(spark):
    """Clusters of near values, sizes from tiny to huge, and infinities."""
    rng = np.random.default_rng(8)
    near = np.concatenate([1e9 + rng.normal(size=500) * 1e-6, -3.0 + rng.normal(size=500) * 1e-12])
    wide = np.concatenate([10.0 ** rng.uniform(-300, 300, 400), -(10.0 ** rng.uniform(-300, 300, 300))])
    ends = np.array([-np.inf] * 9 + [float(i) for i in range(20)] + [np.inf] * 9)
    groups = {"near": near, "wide": wide, "ends": ends, "one": np.array([7.0])}
    df = spark.createDataFrame([(k, float(v)) for k, vs in groups.items() for v in vs], "k string, v double")
    for p in (0.1, 0.5, 0.77):
        got = {r["k"]: r["q"] for r in exact_percentile(df, ["k"], "v", p, "q", ranges=16).collect()}
        for key, values in groups.items():
            want = -np.inf if (key, p) == ("ends", 0.1) else np.percentile(values, p * 100)
            assert got[key] == pytest.approx(want, rel=1e-12), (key, p)


def test_percentile_plan_has_no_step_before_it(spark, monkeypatch):
    """Building the plan runs no job and writes nothing; the distinct values are shuffled once."""
    df = spark.range(1000).selectExpr("id % 3 AS k", "cast(id AS double) AS v")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("planning", "planning")
    out = exact_percentile(df, ["k"], "v", 0.5, "q")
    out._jdf.queryExecution().executedPlan()
    assert not tracker.getJobIdsForGroup("planning")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    out.collect()
    text = out._jdf.queryExecution().executedPlan().toString()
    final = text.split("Initial Plan")[0]
    assert final.count("Scan ExistingRDD") + final.count("Range (0, 1000") == 1


def test_named_functions(spark):
    rng = np.random.default_rng(5)
    names = ["SUM", "avg", "MAX", "MIN", "COUNT", "PERCENTILE", "UNKNOWN"]
    data = {n: rng.normal(size=20 + 10 * i) for i, n in enumerate(names)}
    rows = [(n, n, 80.0, float(v)) for n, values in data.items() for v in values]
    df = spark.createDataFrame(rows, "k string, f string, p double, v double")
    got = {
        r["k"]: r["out"]
        for r in aggregate_by_name(df, ["k"], "f", "p", "v", "out").collect()
    }
    expected = {
        "SUM": np.sum, "avg": np.mean, "MAX": np.max, "MIN": np.min, "COUNT": len,
        "PERCENTILE": lambda x: np.percentile(x, 80),
    }
    assert got.keys() == expected.keys()
    for name, function in expected.items():
        assert got[name] == pytest.approx(function(data[name]))


def test_rate_uses_summed_parts(spark):
    df = spark.createDataFrame(
        [("a", "AVG", 0.0, 2.0, True, 2.0, 1.0), ("a", "AVG", 0.0, 1.0, True, 3.0, 3.0),
         ("b", "AVG", 0.0, 4.0, True, 1.0, 0.0), ("c", "MAX", 0.0, 4.0, True, 9.0, 1.0)],
        "k string, f string, p double, v double, rate boolean, num double, den double",
    )
    out = aggregate_by_name(df, ["k"], "f", "p", "v", "out", ("rate", "num", "den"))
    assert {r["k"]: r["out"] for r in out.collect()} == {"a": 1.25, "b": 4.0, "c": 4.0}


def listed(frame):
    """Values of every group, its rows put together, and the lengths of its rows."""
    values, sizes = {}, {}
    for r in frame.collect():
        values.setdefault(r["dn"], []).extend(r["value_array"])
        sizes.setdefault(r["dn"], []).append(len(r["value_array"]))
        assert r["value_array"] == sorted(r["value_array"]) and r["part"] < r["parts"]
    return {k: sorted(v) for k, v in values.items()}, sizes


@pytest.mark.parametrize("per_row", [7, 50, 100_000])
def test_no_value_is_lost(facts, per_row):
    values = [float(v) for v in range(300)] + [1.0] * 90 + [2.5] * 400
    rows = [("2024-01-05 10:00:00", {"value": v}) for v in values]
    rows += [("2024-01-05 10:05:00", {"value": v, "dn": "other"}) for v in (2.0, 1.0, None)]
    out = wide_agg(facts(rows), per_row=per_row)
    got, sizes = listed(out)
    assert got == {"dn-1": sorted(values), "other": [1.0, 2.0]}
    assert max(sizes["dn-1"]) <= 4 * per_row
    for r in out.where("dn = 'dn-1'").collect():
        assert (r["value_count"], r["value_sum"], r["value_max"]) == (len(values), sum(values), 299.0)
        assert r["__time"].hour == 7 and set(WIDE_KEYS) <= set(r.asDict())


def test_all_null_group_keeps_its_row(facts):
    out = wide_agg(facts([("2024-01-05 10:00:00", {"value": None})])).collect()
    assert len(out) == 1 and out[0]["value_count"] == 0 and out[0]["value_array"] == []


def test_single_array_matches_builtin(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), (F.col("id") * 1.5).alias("v"))
    got = exact_percentile(df, ["k"], "v", 0.37, "q").orderBy("k").collect()
    want = df.groupBy("k").agg(F.percentile("v", 0.37).alias("q")).orderBy("k").collect()
    assert [r["q"] for r in got] == pytest.approx([r["q"] for r in want])
