import pytest
from pyspark.sql import functions as F

from wavemeter.model import METRICS
from wavemeter.operators.rollup import raw_rows
from wavemeter.session import work_folder
from wavemeter.streaming import late
from wavemeter.streaming.jobs import closed, first_level, read_files
from wavemeter.streaming.late import StreamedLevel, count_arrivals, late_ledger, rerun_late, roll_up

KEYS = ("metricId",)


class Job:
    def __init__(self, spark):
        self.spark, self.source = spark, work_folder(spark, "in")
        self.of = StreamedLevel(work_folder(spark, "late"), "15m", KEYS, "10 minutes")
        self.mark = None

    def land(self, df):
        df.coalesce(1).write.mode("append").parquet(self.source)

    def stream(self):
        return read_files(self.spark, self.source, METRICS, options={"maxFilesPerTrigger": "1"})

    def run(self):
        count_arrivals(self.stream(), self.of)
        self.mark = roll_up(self.spark, self.stream(), self.of) or self.mark

    def ledger(self):
        return late_ledger(self.spark, self.of, self.mark)

    def listed(self):
        return sorted((f"{r[0]:%H:%M}" if r[0] else None, *r[1:]) for r in self.ledger().collect())

    def stored(self):
        return self.spark.read.schema(METRICS).parquet(self.source)

    def level(self):
        return {f"{r['__time']:%H:%M}": r["count"] for r in self.spark.read.parquet(self.of.level).collect()}

    def rerun(self):
        rerun_late(self.spark, self.stored(), self.of, self.ledger())


def day(*times):
    return [(f"2024-01-05 {t}", {}) for t in times]


def test_late_rows_are_listed_and_made_good(spark, facts):
    job = Job(spark)
    job.land(facts(day("10:00:00", "10:20:00", "10:46:00")))
    job.run()
    assert job.level() == {"10:00": 1, "10:15": 1} and job.listed() == []
    # Two rows behind the watermark, one of them in a bucket that had none, and one in an open bucket.
    job.land(facts(day("10:03:00", "09:00:00", "10:50:00", "11:30:00")))
    job.run()
    assert job.level() == {"10:00": 1, "10:15": 1, "10:45": 2}
    assert job.listed() == [("09:00", 1, 0, 1), ("10:00", 2, 1, 1)]
    for _ in range(2):
        job.rerun()
        assert job.level() == {"09:00": 1, "10:00": 2, "10:15": 1, "10:45": 2} and job.listed() == []
    # Late once more, for a bucket that was rebuilt.
    job.land(facts(day("10:04:00")))
    job.run()
    assert job.listed() == [("10:00", 3, 2, 1)]
    job.rerun()
    assert job.level()["10:00"] == 3 and job.listed() == []


def test_every_row_is_in_the_level_the_ledger_or_an_open_bucket(spark, facts):
    job = Job(spark)
    minutes = [(7 * i * i) % 360 for i in range(90)]
    for part in (minutes[:20], minutes[20:50], minutes[50:]):
        job.land(facts(day(*(f"{m // 60:02}:{m % 60:02}:00" for m in part))))
        job.run()
    counted = raw_rows(job.stored(), "15m").count()
    last = F.lit(job.mark).cast("timestamp_ntz")
    still_open = raw_rows(job.stored(), "15m").where(F.window("__time", "15 minutes")["end"] > last).count()
    late_rows = sum(r["late"] for r in job.ledger().collect())
    assert late_rows > 0 and sum(job.level().values()) + late_rows + still_open == counted
    job.rerun()
    whole = closed(first_level(raw_rows(job.stored(), "15m"), "15m", KEYS))
    want = {f"{r['__time']:%H:%M}": r["count"] for r in whole.collect()}
    got = job.level()
    assert all(want[t] == n for t, n in got.items()) and sum(got.values()) + still_open == counted


def test_a_failed_batch_is_repeated(spark, facts, monkeypatch):
    job, replace = Job(spark), late.replace_buckets
    job.land(facts(day("10:00:00", "10:01:00", "11:00:00")))

    def failing(*args):
        replace(*args)
        raise RuntimeError("lost after the write")

    monkeypatch.setattr(late, "replace_buckets", failing)
    with pytest.raises(Exception, match="lost after the write"):
        job.run()
    monkeypatch.setattr(late, "replace_buckets", replace)
    job.run()
    assert job.level() == {"10:00": 2} and job.listed() == []


def test_rows_without_a_time_are_listed(spark, facts):
    job = Job(spark)
    job.land(facts(day("10:00:00", "11:00:00")).unionByName(facts(day("10:00:00")).withColumn("__time", F.lit(None).cast("timestamp_ntz"))))
    job.run()
    assert job.listed() == [(None, 1, 0, 1)]
    job.rerun()
    assert job.level() == {"10:00": 1}


def test_nothing_has_landed(spark, facts):
    job = Job(spark)
    job.land(facts(day("10:00:00")).limit(0))
    job.run()
    assert job.listed() == []
