from datetime import datetime

import pytest
from pyspark.sql import functions as F

from wavemeter.operators.status import collector_status, element_status, upsert
from wavemeter.session import work_folder
from wavemeter.sinks.messages import keyed_json, publish
from wavemeter.sinks.tables import (
    compact,
    read_table,
    replace_buckets,
    replace_interval,
    replace_partitions,
    upsert_table,
)


def table(spark, *hours):
    rows = [(datetime(2024, 1, 5, h), f"g{i}", 1.0 * h) for h in hours for i in range(3)]
    return spark.createDataFrame(rows, "__time timestamp_ntz, networkGroup string, v double")


def content(spark, path):
    return sorted((r["__time"].hour, r["networkGroup"], r["v"]) for r in spark.read.parquet(path).collect())


def test_interval_replace(spark):
    path = work_folder(spark, "replace")
    day = (datetime(2024, 1, 5), datetime(2024, 1, 6))
    replace_interval(spark, table(spark, 1, 2, 3, 8), path, *day, ("networkGroup",))
    before = content(spark, path)
    morning = (datetime(2024, 1, 5, 2), datetime(2024, 1, 5, 4))
    changed = table(spark, 2).withColumn("v", F.col("v") + 100)
    for _ in range(2):
        replace_interval(spark, changed, path, *morning, ("networkGroup",))
    after = content(spark, path)
    # Hour 2 is new, hour 3 lost its rows, hours 1, 5 and 8 lie outside the interval.
    assert [r for r in after if r[0] in (1, 8)] == [r for r in before if r[0] in (1, 8)]
    assert {r[0] for r in after} == {1, 2, 8} and all(v == 102 for h, _, v in after if h == 2)


def test_interval_replace_refuses_what_it_would_lose(spark):
    path = work_folder(spark, "refuse")
    day = (datetime(2024, 1, 5), datetime(2024, 1, 6))
    replace_interval(spark, table(spark, *range(24)), path, *day, ("networkGroup",), "day")
    before = content(spark, path)
    with pytest.raises(ValueError, match="not aligned"):
        replace_interval(spark, table(spark, 10, 11), path, datetime(2024, 1, 5, 10), datetime(2024, 1, 5, 12), ("networkGroup",), "day")
    with pytest.raises(Exception, match="outside"):
        replace_interval(spark, table(spark, 10), path, datetime(2024, 1, 6), datetime(2024, 1, 7), ("networkGroup",), "day")
    assert content(spark, path) == before and len(before) == 72


def test_upsert_rewrites_only_the_slots_of_changed_keys(spark):
    path = work_folder(spark, "keyed")

    def batch(rows):
        return spark.createDataFrame(rows, "k string, v int")

    def files():
        return {r[0] for r in spark.read.parquet(path).select(F.input_file_name()).distinct().collect()}

    assert read_table(spark, path) is None
    upsert_table(spark, batch([(f"k{i}", 1) for i in range(50)]), path, ("k",))
    before = files()
    for _ in range(2):
        upsert_table(spark, batch([("k7", 2), ("new", 2)]), path, ("k",))
    assert len(before - files()) <= 2
    upsert_table(spark, batch([]), path, ("k",))
    got = dict(map(tuple, read_table(spark, path).collect()))
    assert got == {f"k{i}": 1 for i in range(50)} | {"k7": 2, "new": 2}


class Killed(Exception):
    pass


@pytest.mark.parametrize("alive_steps", [0, 1, 2, 3])
def test_a_kill_between_the_steps_of_a_replacement_is_made_good(spark, monkeypatch, alive_steps):
    from wavemeter.sinks import tables

    path = work_folder(spark, "killed")
    day = (datetime(2024, 1, 5), datetime(2024, 1, 6))
    replace_interval(spark, table(spark, 1, 2, 3, 8), path, *day, ("networkGroup",))
    swap, done = tables._swap, []

    def dying(*args):
        if len(done) == alive_steps:
            raise Killed
        done.append(args)
        swap(*args)

    changed = table(spark, 1, 2, 5).withColumn("v", F.col("v") + 100)
    monkeypatch.setattr(tables, "_swap", dying)
    with pytest.raises(Killed):
        replace_interval(spark, changed, path, *day, ("networkGroup",))
    monkeypatch.setattr(tables, "_swap", swap)
    # The next run is about another hour and still finishes what the journal says.
    replace_interval(
        spark, table(spark, 20), path, datetime(2024, 1, 5, 20), datetime(2024, 1, 5, 21), ("networkGroup",)
    )
    got = content(spark, path)
    assert {(h, v) for h, _, v in got} == {(1, 101.0), (2, 102.0), (5, 105.0), (20, 20.0)} and len(got) == 12
    assert not [n for n in tables._children(spark, path) if n.startswith("_")]


def test_a_kill_before_the_journal_changes_nothing(spark, monkeypatch):
    from wavemeter.sinks import tables

    path = work_folder(spark, "unjournaled")
    day = (datetime(2024, 1, 5), datetime(2024, 1, 6))
    replace_interval(spark, table(spark, 1, 2), path, *day, ("networkGroup",))
    before = content(spark, path)
    finish, calls = tables.finish_replacement, []

    def dying(*args):
        calls.append(args)
        if len(calls) == 2:
            # As if the journal had been cut off while it was written.
            for name in tables._children(spark, path):
                if name.startswith(tables.JOURNAL):
                    tables._delete(spark, f"{path}/{name}/_SUCCESS")
            raise Killed
        finish(*args)

    monkeypatch.setattr(tables, "finish_replacement", dying)
    with pytest.raises(Killed):
        replace_interval(spark, table(spark, 2, 9), path, *day, ("networkGroup",))
    monkeypatch.setattr(tables, "finish_replacement", finish)
    assert content(spark, path) == before
    replace_interval(spark, table(spark, 2, 9), path, *day, ("networkGroup",))
    assert {h for h, _, _ in content(spark, path)} == {2, 9}


def test_buckets_are_replaced_wherever_they_lie(spark):
    path = work_folder(spark, "buckets")
    replace_buckets(spark, table(spark, 1, 2, 3), path, ("networkGroup",), "day")
    again = table(spark, 3, 7).withColumn("v", F.lit(0.5))
    for _ in range(2):
        replace_buckets(spark, again, path, ("networkGroup",), "day", covered=[datetime(2024, 1, 5, 1), datetime(2024, 1, 5, 3)])
    assert {(h, v) for h, _, v in content(spark, path)} == {(2, 2.0), (3, 0.5), (7, 0.5)}


def test_compaction_keeps_rows_and_replaces_its_partitions(spark):
    stage, lake = work_folder(spark, "stage"), work_folder(spark, "lake")
    spark.range(100).selectExpr("id", "id % 2 AS p").repartition(7).write.partitionBy("p").parquet(stage)
    spark.createDataFrame([(1, 0), (2, 9)], "id long, p long").write.partitionBy("p").parquet(lake)
    compact(spark, stage, lake, ("p",), spread=2)
    rows = spark.read.parquet(lake)
    assert rows.where("p = 0").count() == 50 and rows.where("p = 9").count() == 1
    files = rows.where("p = 1").select(F.input_file_name()).distinct().count()
    assert files <= 2


def test_upsert_takes_the_last_update(spark):
    target = spark.createDataFrame([("a", 1, 0), ("b", 1, 0)], "k string, v int, t int")
    news = spark.createDataFrame([("b", 2, 1), ("b", 3, 2), ("c", 4, 1)], "k string, v int, t int")
    got = upsert(target, news, ("k",), F.col("t"))
    assert sorted(map(tuple, got.collect())) == [("a", 1, 0), ("b", 3, 2), ("c", 4, 1)]


def test_collector_merge(spark):
    now = datetime(2024, 1, 5, 12)
    schema = "device string, lastSeen timestamp_ntz"
    seen = spark.createDataFrame([("on", datetime(2024, 1, 5, 11)), ("late", datetime(2024, 1, 5, 10, 59, 55))], schema)
    old = spark.createDataFrame([("on", datetime(2024, 1, 1)), ("gone", datetime(2024, 1, 5, 11, 30))], schema)
    got = {r["device"]: (r["status"], r["offlineHours"]) for r in collector_status(seen, old, now).collect()}
    assert got == {"on": ("ONLINE", 1.0), "late": ("OFFLINE", 1.001), "gone": ("OFFLINE", 0.5)}


def test_latest_message_wins_and_gaps_are_marked(spark):
    rows = spark.createDataFrame(
        [(datetime(2024, 1, 5, 1), "d", "a", "s1", None), (datetime(2024, 1, 5, 2), "d", "a", "s2", None)],
        "__time timestamp_ntz, dn string, additionalDn string, sourceSystem string, vendorName string",
    ).withColumn("managerIp", F.lit("m")).withColumn("elementType", F.lit("e"))
    got = element_status(rows).first()
    assert (got["sourceSystem"], got["vendorName"]) == ("s2", "não_informado")


def test_publish_to_any_sink(spark):
    path = work_folder(spark, "topic")
    rows = spark.createDataFrame([(1, None), (2, "x")], "id int, t string")
    publish(keyed_json(rows, F.col("id")), "json", {"path": path})
    back = {(r["key"], r["value"]) for r in spark.read.json(path).collect()}
    assert back == {("1", '{"id":1,"t":null}'), ("2", '{"id":2,"t":"x"}')}


def test_cluster_needs_a_shared_folder(spark, monkeypatch):
    from wavemeter import session

    class Conf:
        def get(self, key, default=None):
            return "spark://host" if key == "spark.master" else default

    class Cluster:
        conf = Conf()

    with pytest.raises(ValueError):
        session.work_folder(Cluster(), "x")


def test_a_replacement_builds_its_rows_once_and_splits_a_hot_partition(spark):
    path, built = work_folder(spark, "built-once"), spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            built.add(batch.num_rows)
            yield batch

    rows = spark.range(60_000).selectExpr("CASE WHEN id % 10 = 0 THEN concat('q', id % 50) ELSE 'hot' END AS p", "sha2(cast(id AS string), 256) AS k")
    rows = rows.repartition(8, "k")
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256KB")
    try:
        replace_partitions(spark, rows.mapInArrow(counted, rows.schema), path, "p", ("k",))
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    assert built.value == 60_000
    files = spark.read.parquet(path).select("p", F.input_file_name().alias("f")).distinct()
    counts = {r["p"]: r["count"] for r in files.groupBy("p").count().collect()}
    assert counts.pop("hot") > 1 and len(counts) == 5
    assert spark.read.parquet(path).select("p", "k").exceptAll(rows).count() == 0
    assert spark.read.parquet(path).count() == 60_000
