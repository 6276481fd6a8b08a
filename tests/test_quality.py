from datetime import datetime

from pyspark.sql import functions as F

from wavemeter.operators.quality import completeness, damaged_days, reconcile, reconcile_content, repair
from wavemeter.operators.recompute import due_after, recompute
from wavemeter.operators.rollup import rollup_temporal
from wavemeter.plans.fixtures import metrics


def test_fresh_rollup_reconciles(spark, sf):
    facts = metrics(spark, sf)
    assert reconcile(facts, rollup_temporal(facts, "15m"), "15m").count() == 0


def test_reports_exactly_the_damaged_buckets(spark, sf):
    facts = metrics(spark, sf)
    rolled = rollup_temporal(facts, "15m", sketch=False)
    lost = {r[0] for r in rolled.where(F.col("dn") == "dn-3").select("__time").collect()}
    damaged = rolled.where(F.col("dn") != "dn-3")
    assert lost and {r["__time"] for r in reconcile(facts, damaged, "15m").collect()} == lost


def test_extra_rows_are_reported_too(spark, sf):
    facts = metrics(spark, sf)
    rolled = rollup_temporal(facts, "15m", sketch=False)
    found = reconcile(facts.where(F.col("__time") < "2024-01-10"), rolled, "15m")
    assert found.where("raw_count > 0").count() == 0 and found.count() > 0


def test_repair_heals_and_keeps_the_rest(spark, sf):
    facts = metrics(spark, sf)
    rolled = rollup_temporal(facts, "15m", sketch=False)
    damaged = rolled.where(F.hour("__time") != 6)
    build = lambda df: rollup_temporal(df, "15m", sketch=False)
    fixed = repair(facts, damaged, "15m", build)
    assert reconcile(facts, fixed, "15m").count() == 0
    assert fixed.exceptAll(rolled.select(fixed.columns)).where("sum_value is null").count() == 0
    assert fixed.count() == rolled.count()


def test_damaged_days_follow_the_business_day(spark):
    df = spark.sql(
        "SELECT timestamp_ntz'2024-01-05 02:45:00' AS __time UNION ALL SELECT timestamp_ntz'2024-01-05 03:00:00'"
    )
    assert {r["day"].day for r in damaged_days(df).collect()} == {4, 5}


def test_recompute_touches_only_its_buckets(spark, sf):
    facts = metrics(spark, sf)
    whole = rollup_temporal(facts, "15m", sketch=False)
    some = whole.select("__time").distinct().orderBy("__time").limit(7)
    keys = {r[0] for r in some.collect()}
    part = recompute(facts, some, "15m", sketch=False)
    assert {r[0] for r in part.select("__time").collect()} == keys
    assert part.agg(F.sum("count")).first()[0] == whole.where(F.col("__time").isin(*[
        F.lit(str(k)).cast("timestamp_ntz") for k in keys
    ])).agg(F.sum("count")).first()[0]


def test_next_level_waits_for_its_last_part(spark):
    df = spark.sql(
        "SELECT explode(array(timestamp_ntz'2024-01-05 10:00:00', timestamp_ntz'2024-01-05 10:45:00',"
        " timestamp_ntz'2024-01-05 11:30:00')) AS __time"
    )
    assert [r[0] for r in due_after(df, "15m", "hourly").collect()] == [datetime(2024, 1, 5, 10)]


def test_completeness_decisions(spark):
    scope = "kpi_id string, managedobject_id string, granularityinterval string, aggregation_time string"
    counts = spark.createDataFrame(
        [("full", "o", "t", "D", 95), ("short", "o", "t", "D", 94), ("new", "o", "t", "D", 1),
         ("empty", "o", "t", "D", 0)],
        f"{scope}, records long",
    )
    history = spark.createDataFrame(
        [(k, "o", "t", "D", n) for k in ("full", "short") for n in (90, 100, 110)],
        f"{scope}, records long",
    )
    got = {r["kpi_id"]: r["status"] for r in completeness(counts, history, 95).collect()}
    assert got == {"full": "LOAD", "short": "PARTIAL", "new": "LOAD", "empty": "PARTIAL"}


def test_silent_scope_is_partial(spark):
    schema = "kpi_id string, managedobject_id string, granularityinterval string, aggregation_time string, records long"
    history = spark.createDataFrame([(k, "m", "PT300S", "DAY", 10) for k in ("k1", "k2", None)], schema)
    now = spark.createDataFrame([("k1", "m", "PT300S", "DAY", 10), ("k3", "m", "PT300S", "DAY", 1)], schema)
    out = {r["kpi_id"]: (r["records"], r["status"]) for r in completeness(now, history, 95).collect()}
    assert out == {"k1": (10, "LOAD"), "k2": (0, "PARTIAL"), None: (0, "PARTIAL"), "k3": (1, "LOAD")}


def test_content_differences_with_equal_counts_are_seen(spark, sf):
    facts = metrics(spark, sf)
    build = lambda df: rollup_temporal(df, "15m", sketch=False)
    assert reconcile_content(facts, build(facts), "15m").count() == 0
    day = F.dayofmonth("__time")
    changed = facts.withColumns({
        "value": F.when(day == 9, F.col("value") * 2 + 1).otherwise(F.col("value")),
        "metricId": F.when(day == 12, F.lit("other")).otherwise(F.col("metricId")),
    }).where(day != 15)
    found = reconcile_content(facts, build(changed), "15m").collect()
    assert {(r["what"], r["__time"].day) for r in found} == {("measures", 9), ("identity", 12), ("rows", 15)}
    assert all((r["raw_count"] == r["rolled_count"]) == (r["what"] != "rows") for r in found)
    assert {r["__time"].day for r in reconcile(facts, build(changed), "15m").collect()} == {15}


def test_repair_opens_only_its_interval(spark, sf):
    from datetime import timedelta

    from wavemeter.operators.stored import cascade, repair_stored
    from wavemeter.session import work_folder

    folder = work_folder(spark, "repair")
    paths = {g: f"{folder}/{g}" for g in ("15m", "hourly", "daily")}
    facts, days = metrics(spark, sf), [datetime(2024, 1, d) for d in range(8, 12)]
    cascade(spark, facts.withColumn("dn", F.when(F.dayofmonth("__time") == 10, "x").otherwise(F.col("dn"))), paths, days, sketch=False)
    # The damage lies outside the first interval and inside the second.
    assert repair_stored(spark, facts, paths, days[0] + timedelta(hours=3), days[1], sketch=False) == []
    start = days[2] + timedelta(hours=3)
    assert repair_stored(spark, facts, paths, start, start + timedelta(hours=12), sketch=False) == [days[2]]
    daily = spark.read.parquet(paths["daily"]).where("__time = timestamp_ntz'2024-01-10'")
    assert daily.where("dn = 'x'").select("dn").distinct().count() <= 1 and daily.where("dn <> 'x'").count() > 0
