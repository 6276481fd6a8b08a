import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from wavemeter.model import ELEMENT_MESSAGE, METRICS
from wavemeter.operators.rollup import raw_rows
from wavemeter.operators.status import element_status
from wavemeter.plans.fixtures import EVENTS, metric_view, metrics, table
from wavemeter.session import work_folder
from wavemeter.sinks.tables import read_table
from wavemeter.streaming.elements import track_elements
from wavemeter.streaming.jobs import (
    closed,
    drain,
    drain_batches,
    follow,
    read_files,
    redirect,
    split_stream,
    stream_next_level,
    stream_rollup,
)

KEYS = ("metricId",)
ONE_FILE = {"maxFilesPerTrigger": "1"}


def land(df, folder):
    df.coalesce(1).write.mode("append").parquet(folder)


def results(spark, path):
    return {(r["__time"], r["metricId"]): r["count"] for r in spark.read.parquet(path).collect()}


def test_late_rows_beyond_the_watermark_do_not_reopen_a_bucket(spark, facts):
    source, sink, checkpoint = (work_folder(spark, n) for n in ("in", "out", "ck"))

    def run():
        stream = read_files(spark, source, METRICS, options=ONE_FILE)
        drain(closed(stream_rollup(stream, "15m", KEYS, "10 minutes")), sink, checkpoint)

    land(facts([("2024-01-05 10:00:00", {}), ("2024-01-05 10:14:59", {}), ("2024-01-05 10:22:00", {})]), source)
    run()
    # The watermark is 10:12, so the first bucket is still open.
    assert not spark.read.schema("x int").parquet(sink).count()
    land(facts([("2024-01-05 10:13:00", {}), ("2024-01-05 10:40:00", {})]), source)
    run()
    assert results(spark, sink) == {
        (datetime(2024, 1, 5, 10), "m-1"): 3, (datetime(2024, 1, 5, 10, 15), "m-1"): 1,
    }
    land(facts([("2024-01-05 10:05:00", {}), ("2024-01-05 11:30:00", {})]), source)
    run()
    got = results(spark, sink)
    assert got[(datetime(2024, 1, 5, 10), "m-1")] == 3
    assert got[(datetime(2024, 1, 5, 10, 30), "m-1")] == 1


def test_cascade_equals_batch(spark, sf):
    source, sink, checkpoint = (work_folder(spark, n) for n in ("in", "out", "ck"))
    events = table(spark, sf, "events")
    for low, high in ((1, 11), (11, 21), (21, 32)):
        land(events.where(F.dayofmonth("ts").between(low, high - 1)).orderBy("ts"), source)
    stream = metric_view(read_files(spark, source, EVENTS, options=ONE_FILE))
    hourly = stream_next_level(stream_rollup(stream, "15m", KEYS, "30 days"), "hourly", KEYS)
    drain(closed(hourly), sink, checkpoint)
    land(
        table(spark, sf, "events").limit(1)
        .withColumn("ts", F.lit("2024-06-01").cast("timestamp_ntz"))
        .withColumn("event_id", F.lit(1).cast("long")).withColumn("value", F.lit(1.0)),
        source,
    )
    stream = metric_view(read_files(spark, source, EVENTS, options=ONE_FILE))
    hourly = stream_next_level(stream_rollup(stream, "15m", KEYS, "30 days"), "hourly", KEYS)
    drain(closed(hourly), sink, checkpoint)
    batch = (
        raw_rows(metrics(spark, sf), "15m")
        .groupBy(F.date_trunc("hour", "__time").cast("timestamp_ntz").alias("__time"), "metricId")
        .count()
    )
    assert results(spark, sink) == {(r["__time"], r["metricId"]): r["count"] for r in batch.collect()}


def messages(spark, rows):
    names = [f.name for f in ELEMENT_MESSAGE.fields[1:]]
    data = [(t, *[r.get(n) for n in names]) for t, r in rows]
    return spark.createDataFrame(data, ELEMENT_MESSAGE)


def at(hours, ms=0):
    return datetime(2024, 1, 5) + timedelta(hours=hours, milliseconds=ms)


def element(name, source):
    return {"dn": name, "additionalDn": "x", "sourceSystem": source}


class Elements:
    """Lands messages and runs the job anew, as after a restart."""

    def __init__(self, spark):
        self.spark = spark
        self.source, self.path, self.checkpoint = (work_folder(spark, n) for n in ("in", "elements", "ck"))

    def run(self, *rows):
        if rows:
            land(messages(self.spark, rows), self.source)
        stream = read_files(self.spark, self.source, ELEMENT_MESSAGE, options=ONE_FILE)
        track_elements(self.spark, stream, self.path, self.checkpoint)
        return {r["dn"]: (r["sourceSystem"], r["ativo"]) for r in read_table(self.spark, self.path).collect()}


def test_elements_end_after_a_day_over_restarts(spark):
    job = Elements(spark)
    assert job.run((at(0), element("a", "1")), (at(2), element("b", "1")), (at(3), element("c", "1"))) == {
        "a": ("1", True), "b": ("1", True), "c": ("1", True),
    }
    # 26 hours: a is gone, b is a day old to the millisecond and still counts.
    assert job.run((at(26), element("c", "2"))) == {"a": ("1", False), "b": ("1", True), "c": ("2", True)}
    assert job.run((at(26, 1), element("d", "1"))) == {
        "a": ("1", False), "b": ("1", False), "c": ("2", True), "d": ("1", True),
    }
    # An ended element comes back with its next message.
    got = job.run((at(27), element("a", "3")), (at(26), element("a", "late")))
    assert got["a"] == ("3", True) and got["b"] == ("1", False)
    assert job.run() == got


def test_older_messages_and_ties_do_not_replace(spark):
    job = Elements(spark)
    job.run((at(2), element("a", "new")))
    assert job.run((at(1), element("a", "old")), (at(1), element("b", "b"))) == {"a": ("new", True), "b": ("b", True)}
    # Older than the lifetime when it arrives: nothing is known of a live element.
    assert job.run((at(30), element("b", "b2")), (at(30), element("a", "a2")))["b"] == ("b2", True)
    assert "z" not in job.run((at(1), element("z", "z")), (None, element("y", "y")))


def test_elements_equal_the_batch_status(spark):
    rows = [(at(i % 20), element(f"e{i % 7}", str(i))) for i in range(60)]
    job = Elements(spark)
    for part in (rows[:20], rows[20:45], rows[45:]):
        job.run(*part)
    whole = element_status(spark.read.schema(ELEMENT_MESSAGE).parquet(job.source), ("__time", "sourceSystem"))
    got = read_table(spark, job.path).where("ativo")
    assert {(r["dn"], r["created_at"]) for r in got.collect()} == {(r["dn"], r["created_at"]) for r in whole.collect()}


def test_only_changed_elements_reach_the_table(spark, monkeypatch):
    from wavemeter.streaming import elements

    written = []

    def counting(spark_, batch, *args):
        written.append(sorted((r["dn"], r["ativo"]) for r in batch.collect()))

    job = Elements(spark)
    job.run(*((at(1), element(f"e{i}", "1")) for i in range(5)))
    monkeypatch.setattr(elements, "upsert_table", counting)
    job.run((at(2), element("e3", "2")), (at(0), element("e4", "0")))
    assert [w for w in written if w] == [[("e3", True)]]


def test_elements_of_a_slot_end_each_at_its_own_time(spark):
    from wavemeter.streaming.elements import element_changes, keyed_state

    source, checkpoint, got = work_folder(spark, "in"), work_folder(spark, "ck"), []

    def run(*rows):
        land(messages(spark, rows), source)
        stream = read_files(spark, source, ELEMENT_MESSAGE, options=ONE_FILE)
        got.clear()
        with keyed_state(spark):
            drain_batches(
                element_changes(stream, slots=1),
                lambda batch, n: got.extend((r["dn"], r["sourceSystem"], r["ativo"]) for r in batch.collect()),
                checkpoint, "update",
            )
        return sorted(got)

    first = run((at(3), element("c", "1")), (at(0), element("a", "0")), (at(1), element("a", "1")), (at(2), element("b", "1")))
    assert first == [("a", "1", True), ("b", "1", True), ("c", "1", True)]
    # Neither older messages nor elements that stay are passed on again.
    assert run((at(1), element("c", "0"))) == []
    assert run((at(25, 1), element("d", "1"))) == [("a", "1", False), ("d", "1", True)]
    # The oldest of the slot gets a new message before its end; the next oldest ends at its own time.
    assert run((at(25, 2), element("b", "2"))) == [("b", "2", True)]
    assert run((at(27), element("a", "2"))) == [("a", "2", True)]
    assert run((at(27, 1), element("a", "3"))) == [("a", "3", True), ("c", "1", False)]
    assert run((at(80), element("z", "1"))) == [("a", "3", False), ("b", "2", False), ("d", "1", False), ("z", "1", True)]


def test_a_task_passes_on_one_message_of_an_element():
    import pyarrow as pa

    from wavemeter.streaming.elements import _newest_of_batch

    def batch(start):
        ids = range(start, start + 50)
        return pa.RecordBatch.from_pydict({"k": [None if i % 5 == 4 else i % 5 for i in ids], "t": [None if i % 7 == 0 else i for i in ids]})

    batches = [batch(n) for n in range(0, 500, 50)]
    rows = [r for b in _newest_of_batch(("k",), ("t",))(iter(batches)) for r in b.to_pylist()]
    want = {k: max(r["t"] for b in batches for r in b.to_pylist() if r["k"] == k and r["t"] is not None) for k in (0, 1, 2, 3, None)}
    assert len(rows) == 5 and {r["k"]: r["t"] for r in rows} == want
    assert sum(b.num_rows for b in _newest_of_batch(("k",), ("t",), 100)(iter(batches))) == 25
    assert list(_newest_of_batch(("k",), ("t",))(iter([]))) == []


def test_a_batch_that_fails_in_the_sink_comes_again(spark, monkeypatch):
    from wavemeter.streaming import elements

    job, upsert_table = Elements(spark), elements.upsert_table
    job.run((at(1), element("a", "1")))

    def failing(*args):
        upsert_table(*args)
        raise RuntimeError("lost after the write")

    monkeypatch.setattr(elements, "upsert_table", failing)
    with pytest.raises(Exception, match="lost after the write"):
        job.run((at(3), element("a", "2")), (at(3), element("b", "1")))
    monkeypatch.setattr(elements, "upsert_table", upsert_table)
    assert job.run() == {"a": ("2", True), "b": ("1", True)}


def test_following_stops_in_time_and_goes_on(spark):
    source, sink, checkpoint = (work_folder(spark, n) for n in ("in", "out", "ck"))

    def handle(batch, number):
        batch.write.mode("overwrite").parquet(f"{sink}/batch={number}")

    def run():
        stream = read_files(spark, source, "value string", options=ONE_FILE)
        return follow(stream, handle, checkpoint, "0 seconds", 6)

    for n in range(3):
        land(spark.createDataFrame([(f"{n}-{i}",) for i in range(10)], "value string"), source)
    first = run()
    assert first.rows == 30 and first.batches == 3 and first.rate > 0 and 6 <= first.seconds < 60
    land(spark.createDataFrame([("last",)], "value string"), source)
    assert run().rows == 1
    assert spark.read.parquet(sink).select("value").distinct().count() == 31


def test_following_finishes_the_batch_under_way(spark):
    source, checkpoint = (work_folder(spark, n) for n in ("in", "ck"))
    land(spark.createDataFrame([("x",)], "value string"), source)
    seen = []

    def slow(batch, number):
        time.sleep(4)
        seen.append(batch.count())

    stream = read_files(spark, source, "value string", options=ONE_FILE)
    taken = follow(stream, slow, checkpoint, "0 seconds", 2)
    assert seen == [1] and taken.rows == 1
    assert follow(stream, slow, checkpoint, "0 seconds", 2).rows == 0


def test_malformed_messages_go_to_the_error_table_once(spark):
    source, good, bad, checkpoint = (work_folder(spark, n) for n in ("in", "good", "bad", "ck"))
    text = spark.createDataFrame([('{"dn": "a"}',), ("{broken",), ("",)], "value string")
    land(text, source)
    for _ in range(2):
        stream = read_files(spark, source, text.schema)
        split_stream(stream, ELEMENT_MESSAGE, "host-1", good, bad, checkpoint)
    assert [r["dn"] for r in spark.read.parquet(good).collect()] == ["a"]
    errors = spark.read.parquet(bad)
    assert errors.count() == 2 and {r["key"] for r in errors.collect()} == {"host-1"}


def test_redirect_resumes_where_it_stopped(spark):
    source, sink, checkpoint = (work_folder(spark, n) for n in ("in", "out", "ck"))
    for value in ("one", "two"):
        land(spark.createDataFrame([(value,)], "value string"), source)
        stream = read_files(spark, source, "value string")
        drain(redirect(stream, "moved"), sink, checkpoint)
    assert sorted(map(tuple, spark.read.parquet(sink).collect())) == [("moved", "one"), ("moved", "two")]
