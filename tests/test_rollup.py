from datetime import datetime

from pyspark.sql import functions as F

from wavemeter.functions.quantiles import merge_sketches, sketch_quantile
from wavemeter.operators.rollup import raw_rows, rollup_group, rollup_temporal
from wavemeter.plans.fixtures import metrics


def levels(facts, groups=False, sketch=False):
    build = rollup_group if groups else rollup_temporal
    out, df = [], facts
    for grain in ("15m", "hourly", "daily"):
        df = build(df, grain, sketch)
        out.append(df)
    return out


def test_counts_survive_every_level(spark, sf):
    facts = metrics(spark, sf)
    expected = raw_rows(facts, "15m").count()
    for level in levels(facts):
        assert level.agg(F.sum("count")).first()[0] == expected


def test_group_counts_survive_every_level(spark, sf):
    totals = [level.agg(F.sum("count")).first()[0] for level in levels(metrics(spark, sf), True)]
    assert len(set(totals)) == 1


def test_extremes_enclose_the_average(spark, sf):
    for level in levels(metrics(spark, sf), True):
        bad = level.where(
            (F.col("max_value") < F.col("avg_value") - 1e-9)
            | (F.col("min_value") > F.col("avg_value") + 1e-9)
        )
        assert bad.count() == 0


def test_value_rules(facts):
    t = "2024-01-05 10:00:00"
    df = facts(
        [
            (t, {"dn": "ratio", "isRate": True, "numerator": 6.0, "denominator": 3.0}),
            (t, {"dn": "zero", "isRate": True, "numerator": 6.0, "denominator": 0.0, "value": 7.0}),
            (t, {"dn": "none", "isRate": True, "numerator": 6.0, "value": 8.0}),
            (t, {"dn": "plain", "numerator": 6.0, "denominator": 3.0, "value": 9.0}),
            (t, {"dn": "lost", "value": None}),
            (t, {"dn": "noparts", "isRate": True, "denominator": 3.0, "value": 5.0}),
            (t, {"dn": "other", "reportInterval": 900}),
        ]
    )
    got = {r["dn"]: r["sum_value"] for r in rollup_temporal(df, "15m").collect()}
    assert got == {"ratio": 2.0, "zero": 7.0, "none": 8.0, "plain": 9.0}


def test_bucket_edges(facts):
    df = facts(
        [
            ("2024-01-05 02:45:00", {}),
            ("2024-01-05 02:59:59.999999", {}),
            ("2024-01-05 03:00:00", {}),
        ]
    )
    quarter, hour, day = levels(df)
    assert {(r["__time"], r["count"]) for r in quarter.collect()} == {
        (datetime(2024, 1, 5, 2, 45), 2),
        (datetime(2024, 1, 5, 3), 1),
    }
    assert {r["__time"].hour for r in hour.collect()} == {2, 3}
    assert {(r["__time"], r["count"]) for r in day.collect()} == {
        (datetime(2024, 1, 4), 2),
        (datetime(2024, 1, 5), 1),
    }


def test_tags_of_levels(facts):
    tags = [
        (r["reportInterval"], r["granularityInterval"])
        for level in levels(facts([("2024-01-05 10:00:00", {})]))
        for r in level.collect()
    ]
    assert tags == [(900, "PT900S"), (3600, "PT3600S"), (86400, "PT86400S")]


def test_group_distinct_counts_are_per_timestamp(facts):
    df = facts(
        [
            ("2024-01-05 10:00:00", {"dn": "a", "networkGroups": ["g", "h"]}),
            ("2024-01-05 10:00:00", {"dn": "b", "networkGroups": ["g"]}),
            ("2024-01-05 10:05:00", {"dn": "c", "networkGroups": ["g", None]}),
            ("2024-01-05 10:05:00", {"dn": "d", "networkGroups": None}),
        ]
    )
    rows = {r["networkGroup"]: r for r in rollup_group(df, "15m").collect()}
    assert set(rows) == {"g", "h"}
    assert (rows["g"]["count"], rows["g"]["max_count_dn"], rows["g"]["min_count_dn"]) == (3, 2, 1)


def test_merged_sketch_ranks(spark, sf):
    facts = metrics(spark, sf)
    top = levels(facts, sketch=True)[-1]
    estimate = top.agg(merge_sketches("values_sketch").alias("s")).select(
        sketch_quantile("s", 0.9).alias("q")
    ).first()["q"]
    values = [r["value"] for r in raw_rows(facts, "15m").select("value").collect()]
    rank = sum(v <= estimate for v in values) / len(values)
    assert abs(rank - 0.9) < 0.02
