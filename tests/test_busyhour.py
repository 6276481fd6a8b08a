from datetime import datetime

import pytest

from wavemeter.operators.busyhour import busy_hour_scope, busy_hours

SCHEMA = (
    "node_id string, node_name string, kpi_id string, kpi_name string, managedObject_id string,"
    " managedObject_name string, dataTableName string, defaultTimeGranularity string,"
    " aggregationFunction string, percentileValue double, period string, level array<int>,"
    " effectiveDay string, day1 array<string>, day2 array<string>, effective_hours array<string>,"
    " date string"
)


@pytest.fixture
def config(spark):
    def make(**overrides):
        row = {
            "node_id": "bh", "node_name": "n", "kpi_id": "m-1", "kpi_name": "k",
            "managedObject_id": "mo-1", "managedObject_name": "o", "dataTableName": "t",
            "defaultTimeGranularity": "PT5M", "aggregationFunction": "SUM", "percentileValue": 0.0,
            "period": "WEEKLY_BUSY_HOUR", "level": [1, 2, 3], "effectiveDay": "PERIODDAYS",
            "day1": ["ALLDAYS"], "day2": [None], "effective_hours": ["ALL"], "date": None,
        }
        row.update(overrides)
        return spark.createDataFrame([tuple(row.values())], SCHEMA)

    return make


RUN = datetime(2024, 1, 15, 4)  # a Monday: the week is January 8 to 14


def found(df):
    return [(r["BH_level"], str(r["BH_hour"]), r["BH_value"]) for r in df.orderBy("BH_level").collect()]


def test_ties_go_to_the_earlier_hour_and_levels_may_have_gaps(facts, config):
    df = facts(
        [
            ("2024-01-09 09:00:00", {"value": 5.0}),
            ("2024-01-08 10:05:00", {"value": 2.0}),
            ("2024-01-08 10:55:00", {"value": 3.0}),
            ("2024-01-10 23:00:00", {"value": 4.0}),
            ("2024-01-11 01:00:00", {"value": None}),
        ]
    )
    out = busy_hours(df, config(level=[1, 3]), RUN, "WEEKLY_BUSY_HOUR")
    assert found(out) == [(1, "2024-01-08 10:00:00", 5.0), (3, "2024-01-10 23:00:00", 4.0)]


def test_distinct_days_rank_the_best_hour_of_each_day(facts, config):
    df = facts(
        [
            ("2024-01-08 10:00:00", {"value": 9.0}),
            ("2024-01-08 11:00:00", {"value": 8.0}),
            ("2024-01-09 12:00:00", {"value": 1.0}),
        ]
    )
    out = busy_hours(df, config(), RUN, "WEEKLY_BUSY_HOUR", distinct_days=True)
    assert [v for _, _, v in found(out)] == [9.0, 1.0]


def test_days_and_hours(facts, config):
    rows = [(f"2024-01-{d:02d} {h:02d}:00:00", {"value": float(d + h)}) for d in range(8, 15) for h in (7, 8)]
    weekend = busy_hours(facts(rows), config(day1=["WEEKEND"]), RUN, "WEEKLY_BUSY_HOUR")
    assert {r["BH_hour"].day for r in weekend.collect()} == {13, 14}
    friday = config(effectiveDay="SPECIFICDAYS", day2=["FRIDAY"], effective_hours=["_07_00"])
    assert found(busy_hours(facts(rows), friday, RUN, "WEEKLY_BUSY_HOUR")) == [
        (1, "2024-01-12 07:00:00", 19.0)
    ]


def test_special_date_replaces_the_period(facts, config):
    df = facts([("2023-12-25 08:00:00", {"value": 7.0}), ("2024-01-09 08:00:00", {"value": 9.0})])
    cfg = config(effectiveDay="SPECIALDATES", date="2023-12-25T00:00:00+0000")
    row = busy_hours(df, cfg, RUN, "WEEKLY_BUSY_HOUR").first()
    assert (row["BH_value"], str(row["data_date_end"])) == (7.0, "2023-12-25 23:59:59")


def test_daily_config_skips_other_days(config):
    saturday = config(period="DAILY_BUSY_HOUR", day1=["WEEKEND"])
    assert busy_hour_scope(saturday, datetime(2024, 1, 14, 4), "DAILY_BUSY_HOUR").count() == 1
    assert busy_hour_scope(saturday, datetime(2024, 1, 16, 4), "DAILY_BUSY_HOUR").count() == 0


def test_percentile_is_divided_once(facts, config):
    df = facts([(f"2024-01-09 09:{m:02d}:00", {"value": float(m)}) for m in range(0, 55, 5)])
    cfg = config(aggregationFunction="PERCENTILE", percentileValue=50.0)
    assert found(busy_hours(df, cfg, RUN, "WEEKLY_BUSY_HOUR"))[0][2] == 25.0


def test_window_ends_are_half_open(facts, config):
    df = facts(
        [
            ("2024-01-14 23:59:59.5", {"value": 2.0}),
            ("2024-01-15 00:00:00", {"value": 9.0}),
            ("2024-01-08 00:00:00", {"value": 1.0}),
        ]
    )
    assert [v for _, _, v in found(busy_hours(df, config(), RUN, "WEEKLY_BUSY_HOUR"))] == [2.0, 1.0]


def test_settings_of_one_node_stay_apart(spark, facts, config):
    df = facts([("2024-01-16 10:00:00", {"value": 5.0}), ("2024-01-16 10:05:00", {"value": 7.0})])
    cfg = config().unionByName(config(node_name="m", aggregationFunction="MAX")).unionByName(config())
    out = busy_hours(df, cfg, datetime(2024, 1, 22, 4), "WEEKLY_BUSY_HOUR").collect()
    assert sorted((r["BH_configuration_name"], r["BH_value"]) for r in out) == [("m", 7.0), ("n", 12.0)]


def test_settings_too_large_to_broadcast_give_the_same(spark, facts, config, monkeypatch):
    from wavemeter.operators import busyhour

    df = facts([(f"2024-01-{8 + i % 5:02} {i % 24:02}:05:00", {"value": float(i % 7), "dn": f"dn-{i % 3}"}) for i in range(90)])
    twice = config().unionByName(config()).unionByName(config(node_name="other", aggregationFunction="MAX"))

    def rows():
        out = busy_hours(df, twice, RUN, "WEEKLY_BUSY_HOUR")
        return sorted(map(str, out.select("BH_configuration_name", "dn", "BH_level", "BH_hour", "BH_value").collect()))

    small = rows()
    monkeypatch.setattr(busyhour, "BROADCAST_BYTES", 0)
    # Settings that agree in everything are one.
    assert rows() == small and len(small) == 2 * 3 * 3


def test_few_settings_are_read_once(spark, facts, config):
    df = facts([("2024-01-08 10:05:00", {})])
    text = busy_hours(df, config(), RUN, "WEEKLY_BUSY_HOUR")._jdf.queryExecution().executedPlan().toString()
    assert "sha2" not in text and text.count("LocalTableScan") + text.count("Scan ExistingRDD") >= 2
