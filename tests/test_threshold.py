from datetime import datetime

import pytest
from pyspark.sql import functions as F

from wavemeter.model import THRESHOLDS
from wavemeter.operators.threshold import (
    HISTORY_ALGORITHM,
    RECORD_FIELDS,
    alarm_records,
    evaluate_spatial,
    evaluate_temporal,
    expand_supergroups,
    history_bundle,
    look_backs,
    record_messages,
    record_range,
    spatial_scope,
    thresholds_for,
)

DEFAULTS = {
    "node_id": "t", "node_name": "T", "dataAggregationTime": "NONE",
    "dataAggregationTimeGranularity": "PT5M", "dataAggregationFunction": "SUM",
    "dataAggregationPercentileValue": 0.0, "spatialAggregation": "BY_GROUP",
    "spatialAggregationFunction": "SUM", "spatialAggregationPercentileValue": 0.0,
    "spatialLocationTypeAggregation": "CITY", "id_spatialManagedObjectAggregation": "mo-9",
    "managedObject_id": "mo-1", "managedObject_name": "O", "dataTableName": "t",
    "id_ngInclusion": [], "id_ngInclusion_SG": [], "typeAssociation": [], "equipmentInclusion": [],
    "kpi_id": "m-1", "kpi_name": "K", "kpi_defaultTimeGranularity": "PT5M", "kpi_unit": "Count",
    "kpi_isRate": False, "kpi_hourly": "MAX", "kpi_daily": "MIN", "algorithm": "ABSOLUTE",
    "effectiveDays": "PERIODDAYS", "optionsDays": ["ALLDAYS"], "effectiveHours": ["ALL"],
    "load_status": "Completed", "timeZone": "Z",
}


@pytest.fixture
def config(spark):
    def make(*rows):
        data = [tuple({**DEFAULTS, **row}.get(f.name) for f in THRESHOLDS.fields) for row in rows]
        return spark.createDataFrame(data, THRESHOLDS)

    return make


DAY = (datetime(2024, 1, 5), datetime(2024, 1, 6))


def test_rows_by_granularity_have_no_time_grain(config):
    cfg = config(
        {"node_id": "a"}, {"node_id": "b", "dataAggregationTime": "HOUR"},
        {"node_id": "c", "dataAggregationTime": "null"}, {"node_id": "d", "dataAggregationTime": None},
        {"node_id": "e", "dataAggregationTimeGranularity": "pt5m"},
    )
    got = {r["node_id"] for r in thresholds_for(cfg, "dataAggregationTimeGranularity", "PT5M").collect()}
    assert got == {"a", "c", "d", "e"}
    assert thresholds_for(cfg, "dataAggregationTime", "HOUR").count() == 1


def test_scope_of_a_threshold(facts, config):
    t = "2024-01-05 10:01:00"
    df = facts(
        [
            (t, {"networkGroups": ["a", "b"], "dn": "x", "value": 1.0}),
            (t, {"networkGroups": ["b"], "dn": "y", "value": 2.0}),
            (t, {"networkGroups": None, "dn": "z", "value": 4.0}),
            (t, {"networkGroups": ["c"], "dn": "x", "metricId": "other", "value": 8.0}),
            (t, {"networkGroups": ["c"], "dn": "x", "granularityInterval": "PT900S", "value": 16.0}),
        ]
    )
    cfg = config(
        {"node_id": "all"},
        {"node_id": "b", "id_ngInclusion": ["b"], "typeAssociation": ["GROUP"]},
        {"node_id": "super", "id_ngInclusion": ["b"], "id_ngInclusion_SG": ["a"],
         "typeAssociation": ["SUPERGROUP", "SUPERGROUP"]},
        {"node_id": "dn", "equipmentInclusion": ["y"]},
        {"node_id": "city", "spatialAggregation": "BY_LOCATION"},
    )
    got = {
        (r["node_id"], r["slice"], r["metric0"])
        for r in evaluate_spatial(df, cfg, 5, *DAY).collect()
    }
    assert got == {
        ("all", "a", 1.0), ("all", "b", 3.0), ("b", "b", 3.0), ("super", "a", 1.0), ("dn", "b", 2.0),
        ("city", "x", 7.0),
    }


def test_functions_of_a_grain(facts, config):
    df = facts([("2024-01-05 10:00:00", {"value": 1.0}), ("2024-01-05 10:30:00", {"value": 5.0})])
    cfg = config(
        {"node_id": "hourly", "dataAggregationTime": "HOUR", "dataAggregationFunction": "DEFAULT",
         "spatialAggregation": "NONE"},
        {"node_id": "own", "dataAggregationTime": "HOUR", "dataAggregationFunction": "AVG",
         "spatialAggregation": "NONE"},
        {"node_id": "sliced", "dataAggregationTime": "HOUR", "dataAggregationFunction": "COUNT"},
    )
    rows = evaluate_temporal(df, cfg, "HOUR", *DAY).collect()
    got = {r["node_id"]: (r["aggregation"], r["dn"], r["records"], r["metric0"]) for r in rows}
    assert got == {
        "hourly": ("temporal", "dn-1", 2, 5.0),
        "own": ("temporal", "dn-1", 2, 3.0),
        "sliced": ("temporal-spatial", None, 1, 2.0),
    }


def test_percentage_scales_rates_only(facts, config):
    df = facts([("2024-01-05 10:00:00", {"numerator": 1.0, "denominator": 4.0, "value": 3.0})])
    cfg = config(
        {"node_id": "rate", "kpi_isRate": True, "kpi_unit": "Percentage"},
        {"node_id": "plain", "kpi_unit": "Percentage"},
    )
    got = {r["node_id"]: r["metric0"] for r in evaluate_spatial(df, cfg, 5, *DAY).collect()}
    assert got == {"rate": 25.0, "plain": 3.0}


def test_windows_follow_the_zone(facts, config):
    df = facts([("2024-01-05 02:00:00", {"value": 1.0}), ("2024-01-05 04:00:00", {"value": 2.0})])
    cfg = config(
        {"dataAggregationTime": "DAY", "spatialAggregation": "NONE", "timeZone": "-03:00,-02:00"}
    )
    rows = evaluate_temporal(df, cfg, "DAY", datetime(2024, 1, 1), datetime(2024, 2, 1)).collect()
    assert {(r["window_start"], r["metric0"]) for r in rows} == {
        (datetime(2024, 1, 4, 3), 1.0), (datetime(2024, 1, 5, 3), 2.0),
    }


@pytest.mark.parametrize(
    "overrides,expected",
    [
        ({"times": 3, "intervalDays": 7, "algorithmComparisonValue": 2.9}, [0, 30, 30 + 10080, 30 + 20160]),
        ({"times": 0, "intervalDays": 7, "algorithmComparisonValue": 2.0}, [0]),
        ({"times": -1, "algorithmComparisonValue": 2.0}, [0]),
        ({"times": 2, "intervalDays": 0, "algorithmComparisonValue": 1.0}, [0, 15]),
        ({"times": 3, "intervalDays": 1, "algorithm": "OTHER"}, [0]),
        ({"times": 3, "algorithmComparisonValue": 2.0, "algorithm": "HISTORICAL_VALUE"}, [0, 30]),
    ],
)
def test_look_backs(config, overrides, expected):
    cfg = config({"algorithm": HISTORY_ALGORITHM, **overrides})
    assert cfg.select(look_backs(15)).first()[0] == expected


def test_history_bundle(facts, config):
    df = facts(
        [
            ("2024-01-05 10:01:00", {"value": 5.0}),
            ("2024-01-05 09:55:00", {"value": 4.0}),
            ("2024-01-04 09:56:00", {"value": 3.0}),
            ("2024-01-03 09:56:00", {"value": 2.0}),
        ]
    )
    cfg = config(
        {"algorithm": HISTORY_ALGORITHM, "times": 2, "intervalDays": 1, "algorithmComparisonValue": 1.0}
    )
    bounds = (datetime(2024, 1, 5, 10), datetime(2024, 1, 5, 10, 5))
    result = evaluate_spatial(df, cfg, 5, *bounds)
    spans = record_range(spatial_scope(df, cfg, 5, *bounds))
    records = alarm_records(result, spans, cfg, 300, "PT300S", bounds[1])
    assert set(RECORD_FIELDS) <= set(records.columns)
    # Records given twice change nothing.
    bundle = history_bundle(records.unionByName(records)).collect()
    assert len(bundle) == 1
    row = bundle[0]
    assert row["current"]["value"] == 5.0
    assert sorted(v["value"] for v in row["values"].values()) == [3.0, 4.0]
    begin = row["current"]["beginTime"]
    assert row["current"]["endTime"] == begin + 299_000 and all(t < begin for t in row["values"])


def test_messages_are_keyed_by_element_and_threshold(facts, config):
    df = facts([("2024-01-05 10:00:00", {"dn": 'a$$"b"'})])
    cfg = config({"dataAggregationTime": "HOUR", "spatialAggregation": "NONE"})
    result = evaluate_temporal(df, cfg, "HOUR", *DAY)
    spans = df.select(
        F.lit("t").alias("node_id"), F.lit("m-1").alias("kpi_id"),
        F.date_trunc("hour", "__time").cast("timestamp_ntz").alias("window_start"),
        F.col("__time").alias("min_record"), F.col("__time").alias("max_record"),
    )
    message = record_messages(alarm_records(result, spans, cfg, 3600, "PT3600S", DAY[1])).first()
    assert message["key"] == "a,b+t"
    assert '"aggregation":"temporal"' in message["value"] and '"technology":null' in message["value"]


def limited(groups=(), dns=()):
    return {"id_ngInclusion": list(groups), "equipmentInclusion": list(dns)}


@pytest.mark.parametrize("largest", [None, 0])
def test_limits_are_equal_keys_of_the_join(spark, facts, config, monkeypatch, largest):
    """The index of elements and groups gives what list predicates would, broadcast or not."""
    from wavemeter.operators import threshold

    if largest is not None:
        monkeypatch.setattr(threshold, "BROADCAST_BYTES", largest)
    t = "2024-01-05 10:01:00"
    elements = [("dn-0", ["g-1"]), ("dn-1", ["g-1", "g-2", "g-2"]), ("dn-2", ["g-3", None]), ("dn-3", None), ("dn-4", []), (None, ["g-2"])]
    rows = facts([(t, {"dn": dn, "networkGroups": groups}) for dn, groups in elements])
    limits = {
        "all": limited(), "one": limited(dns=["dn-1", "dn-1"]), "null-dn": limited(dns=[None]),
        "groups": limited(groups=["g-2", "g-1"]), "none": limited(groups=["g-9"]),
        "both": limited(groups=["g-3"], dns=["dn-1", "dn-2"]), "null-lists": {"id_ngInclusion": None, "equipmentInclusion": None},
    }
    cfg = config(*({"node_id": n, **limit} for n, limit in limits.items()))
    scope = spatial_scope(rows, cfg, 5, *DAY)
    got = {(r["node_id"], r["dn"]) for r in scope.collect()}

    def applies(limit, dn, groups):
        wanted, only = limit["id_ngInclusion"] or [], limit["equipmentInclusion"] or []
        return (not wanted or bool(set(wanted) & set(groups or []))) and (not only or (dn is not None and dn in only))

    want = {(n, dn) for n, limit in limits.items() for dn, groups in elements if applies(limit, dn, groups)}
    assert got == want and scope.count() == len(want)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = spatial_scope(rows, cfg, 5, *DAY)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert ("BroadcastHashJoin" in text) == (largest is None) and "array_contains(only_dn" not in text


def test_many_thresholds_with_long_element_lists(spark, config, monkeypatch):
    """Each of many thresholds names many elements: the join has equal keys and no fixed row limit."""
    from wavemeter.operators import threshold
    from wavemeter.plans.fixtures import metrics

    facts = metrics(spark, "/root/testdata/sf0.001")
    dns = sorted(r[0] for r in facts.select("dn").distinct().collect())
    cfg = config(*(
        {"node_id": f"t{i}", "kpi_id": "view", "managedObject_id": f"mo-{i % 3}", **limited(dns=[*dns[i % 7 :: 3], *(f"x{i}-{n}" for n in range(1000))])}
        for i in range(150)
    ))
    known = threshold.config_facts(cfg, 5)
    assert known.index_bytes > 150 * 1000 * 64 and known.kinds == {"dn"}
    span = (datetime(2024, 1, 1), datetime(2024, 2, 1))
    small = spatial_scope(facts, cfg, 5, *span)
    monkeypatch.setattr(threshold, "BROADCAST_BYTES", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")

    def counts(df):
        return sorted(map(tuple, df.groupBy("node_id", "dn").count().collect()))

    try:
        large = spatial_scope(facts, cfg, 5, *span)
        assert "SortMergeJoin" in large._jdf.queryExecution().executedPlan().toString()
        by_shuffle = counts(large)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")

    listed = [(f"t{i}", dn) for i in range(150) for dn in dns[i % 7 :: 3]]
    plain = facts.where("metricId = 'view' AND granularityInterval = 'PT300S'").groupBy("dn", "managedObjectId").count().collect()
    want = sorted((t, r["dn"], r["count"]) for t, dn in listed for r in plain if r["dn"] == dn and r["managedObjectId"] == f"mo-{int(t[1:]) % 3}")
    assert counts(small) == by_shuffle == want and want


def test_records_describe_their_facts_where_they_agree(spark, facts, config):
    t = "2024-01-05 10:0{}:00"
    rows = facts([(t.format(i), {"category": "c", "equipmentTypeId": f"et-{i}"}) for i in range(3)])
    rows = rows.withColumn("domain", F.when(F.minute("__time") > 0, F.lit("RAN")))
    cfg = config({"node_id": "a"})
    result = evaluate_spatial(rows, cfg, 5, *DAY)
    spans = record_range(spatial_scope(rows, cfg, 5, *DAY))
    got = alarm_records(result, spans, cfg, 300, "PT300S", DAY[0]).first()
    # The types differ, the domain is known of some facts only, and the facts have no technology.
    assert (got["category"], got["equipmentTypeId"], got["domain"], got["technology"]) == ("c", None, "RAN", None)
    assert got.asDict().keys() >= set(RECORD_FIELDS)


def test_messages_of_bundles(spark, facts, config):
    import json

    from wavemeter.operators.threshold import bundle_messages

    hours = ("10:00:00", "09:55:00", "09:50:00")
    rows = facts([(f"2024-01-05 {t}", {"value": float(i)}) for i, t in enumerate(hours)])
    cfg = config({"node_id": "a", "algorithm": HISTORY_ALGORITHM, "algorithmComparisonValue": 1.0, "intervalDays": 0, "times": 2})
    result = evaluate_spatial(rows, cfg, 5, *DAY)
    spans = record_range(spatial_scope(rows, cfg, 5, *DAY))
    bundles = history_bundle(alarm_records(result, spans, cfg, 300, "PT300S", DAY[0]))
    found = {r["key"]: [] for r in bundle_messages(bundles).collect()}
    for r in bundle_messages(bundles).collect():
        found[r["key"]].append(json.loads(r["value"]))
    assert len(found) == 1 and next(iter(found)).endswith("+a")
    for message in next(iter(found.values())):
        assert set(message) == {"current", "values", "thresholdId"} and message["thresholdId"] == "a"
        assert set(message["current"]) == set(RECORD_FIELDS)
        assert all(int(k) == v["beginTime"] < message["current"]["beginTime"] for k, v in message["values"].items())
    assert any(m["values"] for m in next(iter(found.values()))) and any(not m["values"] for m in next(iter(found.values())))


def test_children_are_listed_once_for_every_set_of_supergroups(spark, config):
    both, mixed = ["SUPERGROUP", "SUPERGROUP"], ["SUPERGROUP", "GROUP"]
    cfg = config(
        *({"node_id": f"t{i}", "id_ngInclusion": [["s1", "s2"], ["s2", "s1"]][i % 2], "typeAssociation": both} for i in range(40)),
        {"node_id": "mixed", "id_ngInclusion": ["s1", "s2"], "typeAssociation": mixed},
        {"node_id": "none", "id_ngInclusion": ["s3"], "typeAssociation": ["SUPERGROUP"]},
        # Rows of one threshold and KPI share what any of them includes, also the row with a plain group.
        {"node_id": "split", "id_ngInclusion": ["s1"], "typeAssociation": ["SUPERGROUP"]},
        {"node_id": "split", "kpi_name": "L", "id_ngInclusion": ["s2", None], "typeAssociation": both},
        {"node_id": "split", "kpi_name": "M", "id_ngInclusion": ["g"], "typeAssociation": ["GROUP"]},
        {"node_id": None, "id_ngInclusion": ["s1"], "typeAssociation": ["SUPERGROUP"]},
    )
    rows = [("b", "s1", ["ALARMS"]), ("a", "s1", ["REPORTS", "ALARMS"]), ("a", "s2", ["ALARMS"]), ("c", "s2", ["ALARMS"]),
            ("c", "s2", ["ALARMS"]), ("d", "s2", ["REPORTS"]), (None, "s2", ["ALARMS"]), ("e", None, ["ALARMS"])]
    children = spark.createDataFrame(rows, "id string, parentId string, targetGroups array<string>")
    out = expand_supergroups(cfg, children)
    assert sorted(out.columns) == sorted(cfg.columns)
    got = {}
    for r in out.collect():
        got.setdefault(r["node_id"], []).append(r["id_ngInclusion_SG"])
    assert got.pop("split") == [["a", "b", "c"]] * 3
    assert [got.pop(k) for k in ("mixed", "none", None)] == [[[]]] * 3
    assert len(got) == 40 and all(v == [["a", "b", "c"]] for v in got.values())
    # No step has a row for every threshold and child.
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_set(__child" in plan
    keys = [line.split("Aggregate [")[1].split("]")[0] for line in plan.splitlines() if "collect_set(__child" in line]
    assert all("__parent" in k and "node_id" not in k for k in keys)
