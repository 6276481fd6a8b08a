from datetime import datetime, timedelta

import pytest

from wavemeter.operators import incremental
from wavemeter.operators.counters import KEYS, TEMPLATES, counter_agg
from wavemeter.operators.incremental import (
    FIRST_LOOK_BACK,
    advance_mark,
    published,
    read_mark,
    run_incremental,
)
from wavemeter.session import work_folder

SPECS = TEMPLATES["second_to_5_minute"]
DAY = datetime(2024, 1, 5)


def at(minutes):
    return DAY + timedelta(minutes=minutes)


def samples(spark, *minutes):
    names = ", ".join(f"{k} string" for k in KEYS)
    rows = [(at(m), *["k"] * len(KEYS), "n", "c", float(m), f"f-{m}") for m in minutes]
    return spark.createDataFrame(rows, f"__time timestamp_ntz, {names}, name string, code string, value double, managerFilename string")


def whole(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


class Job:
    def __init__(self, spark):
        folder = work_folder(spark, "job")
        self.spark, self.out, self.marks = spark, f"{folder}/out", f"{folder}/marks"

    def run(self, facts, now):
        return run_incremental(self.spark, facts, SPECS, self.out, self.marks, "j", now)

    @property
    def mark(self):
        return read_mark(self.spark, self.marks, "j")


def test_several_runs_equal_one(spark):
    facts = samples(spark, *range(60))
    many, one = Job(spark), Job(spark)
    assert many.mark is None
    assert many.run(facts, at(12)) == at(10) == many.mark
    assert many.run(facts, at(14)) is None and many.mark == at(10)
    assert many.run(facts, at(31)) == at(30)
    assert many.run(facts, at(60)) == at(60)
    one.run(facts, at(60))
    assert whole(published(spark, many.out)) == whole(published(spark, one.out)) == whole(counter_agg(facts, SPECS))


@pytest.mark.parametrize("broken", ["advance_mark", "replace_partitions"])
def test_a_run_that_dies_is_repeated_without_duplicates(spark, monkeypatch, broken):
    facts, job = samples(spark, *range(60)), Job(spark)
    job.run(facts, at(12))
    works = getattr(incremental, broken)

    def dying(*args, **kwargs):
        if broken == "replace_partitions":
            works(*args, **kwargs)
        raise RuntimeError("killed")

    monkeypatch.setattr(incremental, broken, dying)
    with pytest.raises(RuntimeError):
        job.run(facts, at(31))
    monkeypatch.setattr(incremental, broken, works)
    assert job.mark == at(10)
    # The next run comes later and so covers more than the one that died.
    assert job.run(facts, at(47)) == at(45)
    rows = published(spark, job.out)
    assert rows.count() == rows.dropDuplicates(["__time", "name"]).count()
    assert whole(rows) == whole(counter_agg(facts.where(f"__time < timestamp_ntz'{at(45)}'"), SPECS))


def test_the_mark_is_the_end_of_what_was_published(spark):
    job = Job(spark)
    job.run(samples(spark, 1, 2, 12), at(40))
    # Buckets after the last row stay open to rows that come later.
    assert job.mark == at(15)
    job.run(samples(spark, 1, 2, 12, 22), at(40))
    assert job.mark == at(25) and published(spark, job.out).count() == 3 * len(SPECS)


def test_a_first_run_looks_back_a_day(spark):
    job = Job(spark)
    facts = samples(spark, -2000, -1431, -1428, 3)
    job.run(facts, at(10))
    assert {r[0] for r in published(spark, job.out).select("__time").collect()} == {
        at(-1430), at(0),
    } and FIRST_LOOK_BACK == timedelta(days=1)


def test_marks_of_other_layouts_and_jobs(spark):
    marks = work_folder(spark, "marks")
    assert read_mark(spark, marks, "a") is None
    advance_mark(spark, marks, "a", at(5), at(6))
    advance_mark(spark, marks, "b", at(50), at(51))
    advance_mark(spark, marks, "a", at(10), at(11))
    assert read_mark(spark, marks, "a") == at(10) and read_mark(spark, marks, "b") == at(50)
    for text in ("01/05/2024 00:20:00", "05-01-2024 00:20:00", "2024/01/05 00:20:00", "1704414000000", "2024-01-05T00:20:00.000Z"):
        row = spark.createDataFrame([(text, at(1), "c")], "mark string, run_ts timestamp_ntz, job string")
        row.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("job").parquet(marks)
        assert read_mark(spark, marks, "c") == at(20), text


def test_only_runs_before_the_end_are_opened(spark):
    job = Job(spark)
    facts = samples(spark, *range(60))
    for now in (12, 31, 60):
        job.run(facts, at(now))
    part = published(spark, job.out, at(0), at(25))
    assert {r[0] for r in part.select("__time").collect()} == {at(m) for m in range(0, 25, 5)}
    assert len(part.inputFiles()) >= 1 and "run#" in part._jdf.queryExecution().executedPlan().toString()
