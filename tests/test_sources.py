from datetime import datetime, timedelta

from pyspark.sql import functions as F
from pyspark.sql import types as T

from wavemeter.functions.scalars import attachment_name, fill_template, spatial_dn
from wavemeter.model import METRICS
from wavemeter.operators.enrich import dimension_table, lookup
from wavemeter.sources.configs import flatten_busy_hours, flatten_thresholds, hour_text
from wavemeter.sources.landed import (
    alert_rows,
    default_start,
    index_documents,
    list_files,
    map_fields,
    parse_query_log,
    read_facts,
    recent_log_lines,
)
from wavemeter.session import work_folder


def texts(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_facts_of_an_interval(spark, facts):
    path = work_folder(spark, "facts")
    facts([("2024-01-05 10:00:00", {}), ("2024-01-05 11:00:00", {})]).write.parquet(path)
    got = read_facts(spark, path, METRICS, datetime(2024, 1, 5, 10), datetime(2024, 1, 5, 11))
    assert got.count() == 1
    assert "LessThan(__time" in got._jdf.queryExecution().executedPlan().toString()


def test_file_listing(spark, tmp_path):
    (tmp_path / "a").mkdir()
    for name in ("a/one.csv", "a/two.txt", "three.csv"):
        (tmp_path / name).write_text("x")
    listing = list_files(spark, str(tmp_path), ".csv")
    assert {r["managerFilename"] for r in listing.collect()} == {"one.csv", "three.csv"}
    future = datetime.now() + timedelta(days=1)
    assert list_files(spark, str(tmp_path), ".csv", after=future).count() == 0
    assert list_files(spark, str(tmp_path), ".csv", before=future).count() == 2


def test_documents_without_parts(spark):
    docs = texts(
        spark, "{", "{}", '{"thresholds": {"edges": []}}',
        '{"thresholds": {"edges": [{"node": {"id": "t", "status": true, "dataAggregationTime": "HOUR",'
        ' "expression": {"terms": [{"kpi": {"id": "k"}}]}}}]}}',
        '{"thresholds": {"edges": [{"node": {"id": "n", "status": true, "dataAggregationTime": "NONE",'
        ' "spatialAggregation": "NONE", "expression": {"terms": [{"kpi": {"id": "k"}}]}}}]}}',
    )
    rows = flatten_thresholds(docs).collect()
    assert [(r["node_id"], r["id_ngInclusion"], r["effectiveHours"]) for r in rows] == [("t", [], [])]
    assert flatten_busy_hours(texts(spark, "{", '{"busyHours": {"edges": [{"node": null}]}}')).count() == 0


def test_hour_words(spark):
    got = texts(spark, "_08_30", "ALL", "09:00").select(hour_text(F.col("value"))).collect()
    assert [r[0] for r in got] == ["08:30", "ALL", "09:00"]


def test_templates(spark):
    row = spark.range(1).select(
        fill_template(F.lit("<a>-<b>-<a>-<$1>"), F.create_map(F.lit("a"), F.lit("x.$1"))).alias("t")
    ).first()
    assert row["t"] == "x.$1-null-x.$1-null"


def test_names(spark):
    row = spark.range(1).select(
        attachment_name(F.lit("Relatório São João Ç.csv")).alias("a"),
        attachment_name(F.lit("Café 1")).alias("b"),
        spatial_dn(F.lit("m"), F.lit("n"), F.lit("BY_GROUP"), F.lit(None).cast("string")).alias("c"),
    ).first()
    assert tuple(row) == ("relatorio_sao_joao_c.csv", "cafe_1", "m-n-BY_GROUP-")


def test_log_lines(spark):
    stamp = "2024-01-05T10:00:00.000Z"
    lines = texts(
        spark,
        f'{stamp}\tip\t{{"queryType":"q","intervals":{{"type":"s","segments":[1,[2,3],{{"a":[4]}}]}},"x":"]"}}',
        f'{stamp}\tip\t{{"queryType":"q"\t{{"query":"s"}}',
        "2024-01-05T09:00:00.000Z\told", "no time", f"{stamp}",
    )
    recent = recent_log_lines(lines.unionByName(lines), datetime(2024, 1, 5, 9, 30))
    rows = parse_query_log(recent).collect()
    assert len(rows) == 3
    by_type = [r["queryType_json"] for r in rows if r["queryType_json"]]
    assert len(by_type) == 1 and '"segments":3' in by_type[0] and '"x":"]"' in by_type[0]
    assert [r["query_json"] for r in rows if r["query_json"]] == ['{"query":"s"}']


def test_alert_defaults(spark):
    rows = alert_rows(texts(spark, '{"sendToEmail": {"list": ["a"]}}', '{"alarmId": "1"}', "x")).collect()
    assert len(rows) == 1
    assert (rows[0]["severity"], rows[0]["icon"], rows[0]["subject"]) == (
        "Sem informação", "⚪", " SEM INFORMAÇÃO ALERTA: Sem informação REGRA: Sem informação",
    )


def test_index_patterns_prefer_the_longest(spark):
    docs = texts(
        spark, '{"_index": "ab-1", "_source": {"x": "2024-01-05T00:00:00Z", "y": "2024-01-06T00:00:00Z"}}',
        '{"_index": "a-1", "_source": {"x": "2024-01-07"}}', '{"_index": "z", "_source": {"x": "2024-01-07"}}',
        "broken", '{"_index": "ab-2", "_source": {"y": 1704585600000}}',
    )
    out = index_documents(
        docs, {"a*": "x", "ab*": "y"}, datetime(2024, 1, 1), datetime(2024, 1, 7), ("ab-9",)
    ).collect()
    assert [(r["_index"], r["date"].day) for r in out if r["_index"] != "ab-2"] == [("a-1", 7), ("ab-1", 6)]
    assert len(out) == 3


def test_mapping_of_absent_paths(spark):
    rows = spark.createDataFrame(
        [((("n",),), ("i",))],
        T.StructType([
            T.StructField("attributes", T.StructType([T.StructField("p", T.StructType([T.StructField("q", T.StringType())]))])),
            T.StructField("discoveryAttributes", T.StructType([T.StructField("ip", T.StringType())])),
        ]),
    )
    row = map_fields(rows, {"s.q": "attributes.p.q", "s.none": "attributes.p.x.y", "all.*": ""}, {"c": 1}).first()
    assert (row["s"]["q"], row["s"]["none"], row["all"]["ip"], row["c"]) == ("n", None, "i", 1)


def test_lookup_misses_are_null(spark):
    rows = spark.createDataFrame([("a", "A"), ("b", None)], "id string, name string")
    table = dimension_table(rows, "id", ("name",))
    got = lookup(texts(spark, "a", "b", None), table, "name", F.col("value"), "out").collect()
    assert {r["value"]: r["out"] for r in got} == {"a": "A", "b": None, None: None}


def test_default_start():
    now = datetime(2024, 1, 5)
    assert default_start(now, None) == datetime(2024, 1, 4)
    assert default_start(now, datetime(2024, 1, 1)) == datetime(2024, 1, 1)


def test_documents_of_one_file_are_read_by_many_tasks(spark):
    from wavemeter.plans.fixtures import ROWS_PER_TASK
    from wavemeter.plans.landing import threshold_documents

    folder, rows = work_folder(spark, "parts"), ROWS_PER_TASK * 2 + 5
    parts = spark.range(rows).selectExpr("if(id % 9 = 0, null, id div 2) AS p_partkey", "'p' AS p_name")
    parts.coalesce(1).write.parquet(f"{folder}/part.parquet")
    docs = threshold_documents(spark, folder)
    assert docs.rdd.getNumPartitions() == 3
    assert docs.groupBy("doc_order").count().exceptAll(
        parts.groupBy("p_partkey").count()
    ).count() == 0 and docs.count() == rows
    # The largest task holds no more than its share of the keyed rows.
    held = docs.where("doc_order IS NOT NULL").rdd.mapPartitions(lambda part: [sum(1 for _ in part)]).collect()
    assert max(held) < 1.1 * ROWS_PER_TASK
