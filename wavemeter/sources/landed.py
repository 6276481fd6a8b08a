"""Landed JSON, log and listing data as typed rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wavemeter.functions.scalars import (
    SEVERITY_COLOURS,
    SEVERITY_ICONS,
    NO_INFORMATION,
    attachment_name,
    bracket_list,
    classify,
    epoch_minute,
    fill_template,
    literal_map,
    or_marker,
    severity,
)
from wavemeter.functions.timeutil import from_millis, ts_lit
from wavemeter.model import ALERT, PROMQL_DOCUMENT, REPORT_REQUEST
from wavemeter.operators.counters import parse_any_time
from wavemeter.operators.predicates import active_elements

# ---------------------------------------------------------------- facts and messages


def read_facts(
    spark: SparkSession, path: str, schema: T.StructType, start: datetime, end: datetime,
    ts: str = "__time",
) -> DataFrame:
    """Facts of ``[start, end)`` from Parquet; the bounds reach the scan."""
    facts = spark.read.schema(schema).parquet(path)
    return facts.where((F.col(ts) >= ts_lit(start)) & (F.col(ts) < ts_lit(end)))


# How a partition of a stored table names its time.
PARTITION = "bucket_day"
LABELS = {"day": "%Y%m%d", "hour": "%Y%m%d%H", "minute": "%Y%m%d%H%M"}


def partition_label(moment: datetime, grain: str) -> str:
    """Name of the partition that holds a time; a letter in front keeps the names text."""
    return moment.strftime(f"t{LABELS[grain]}")


def read_interval(
    spark: SparkSession, path: str, start: datetime, end: datetime, grain: str,
    schema: T.StructType | None = None, ts: str = "__time",
) -> DataFrame:
    """Rows of ``[start, end)`` of a table partitioned by time.

    The bounds become a predicate on the partitions, so other folders are not opened, and one
    on the time itself, which reaches the scan. With ``schema`` no footer is read to plan.
    """
    reader = spark.read.schema(schema.add(PARTITION, "string")) if schema else spark.read
    last = end - timedelta(microseconds=1)
    label = F.col(PARTITION)
    inside = (F.col(ts) >= ts_lit(start)) & (F.col(ts) < ts_lit(end))
    return (
        reader.parquet(path)
        .where((label >= partition_label(start, grain)) & (label <= partition_label(last, grain)))
        .where(inside)
        .drop(PARTITION)
    )


def read_buckets(
    spark: SparkSession, path: str, hours: Sequence[datetime], grain: str
) -> DataFrame:
    """Rows of the partitions that hold the given times, and of no other."""
    names = sorted({partition_label(h, grain) for h in hours})
    return spark.read.parquet(path).where(F.col(PARTITION).isin(*names)).drop(PARTITION)


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Same-schema parts as one frame."""
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame)
    return first


MALFORMED = "__malformed"


def decode(messages: DataFrame, schema: T.StructType, text: str = "value") -> DataFrame:
    """Message columns plus ``record``: the decoded struct, null for malformed text.

    One pass over the text tells both: text that is no JSON object of this shape lands in a
    field of its own.
    """
    marked = T.StructType([*schema.fields, T.StructField(MALFORMED, T.StringType())])
    parsed = F.from_json(
        text, marked, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": MALFORMED}
    )
    return messages.withColumn("__parsed", parsed).withColumn(
        "record",
        F.when(
            F.col("__parsed").isNotNull() & F.col(f"__parsed.{MALFORMED}").isNull(),
            F.struct(*[F.col(f"__parsed.{f.name}").alias(f.name) for f in schema.fields]),
        ),
    ).drop("__parsed")


def split_malformed(
    messages: DataFrame, schema: T.StructType, host: str, text: str = "value"
) -> tuple[DataFrame, DataFrame]:
    """``(records, error records)``; an error record holds host, reason and the raw text."""
    decoded = decode(messages, schema, text)
    carried = [c for c in messages.columns if c != text]
    good = decoded.where(F.col("record").isNotNull()).select(*carried, "record.*")
    bad = decoded.where(F.col("record").isNull()).select(
        *carried,
        F.lit(host).alias("host"),
        F.lit("malformed JSON").alias("erro"),
        F.col(text).alias("data"),
    )
    return good, bad


# ---------------------------------------------------------------- PromQL vectors

# Source system by metric name, and the length of a sample.
SOURCE_RULES = {"ctf5g": "ctf5g", "ctf4g": "ctf4g"}
SOURCE_DEFAULT = "ctf_infra"
SAMPLE_SECONDS = 300


def promql_rows(
    landed: DataFrame, templates: Mapping[str, str], metric_template: Mapping[str, str],
    device_suffix: str, family: str, vendor: str, ip: str = "ip", text: str = "value",
) -> DataFrame:
    """Counter rows of PromQL instant vectors.

    The element name comes from the template of the metric, filled with the labels of the
    sample; the begin time is the minute of the sample.
    """
    parsed = landed.select(F.col(ip).alias("managerIp"), F.from_json(text, PROMQL_DOCUMENT).alias("d"))
    sample = parsed.select("managerIp", F.explode("d.data.result").alias("s"))
    labels = F.col("s.metric")
    metric = F.try_element_at(labels, F.lit("__name__"))
    device = F.concat(F.try_element_at(labels, F.lit("sitename")), F.lit(device_suffix))
    name_of = F.try_element_at(literal_map(metric_template), metric)
    template = F.try_element_at(literal_map(templates), name_of)
    all_labels = F.map_concat(
        F.map_filter(labels, lambda k, v: k != "additionalDn"),
        F.create_map(F.lit("additionalDn"), device),
    )
    begin = epoch_minute(F.element_at("s.value", 1).cast("double"))
    return sample.select(
        F.lit(family).alias("familyId"),
        metric.alias("code"),
        metric.alias("name"),
        fill_template(template, all_labels).alias("dn"),
        F.element_at("s.value", 2).alias("value"),
        begin.alias("beginTime"),
        (begin + SAMPLE_SECONDS).alias("endTime"),
        F.lit(f"PT{SAMPLE_SECONDS}S").alias("granularityInterval"),
        F.lit(SAMPLE_SECONDS).alias("reportInterval"),
        F.lit(family).alias("elementType"),
        device.alias("additionalDn"),
        F.lit(vendor).alias("vendorName"),
        classify(metric, SOURCE_RULES, SOURCE_DEFAULT).alias("sourceSystem"),
        F.lit("N/A").alias("isReliable"),
        "managerIp",
        F.lit("N/A").alias("managerFilename"),
    )


# ---------------------------------------------------------------- query logs

LOG_TIME = r"^(\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}\.\d{3}Z)"


def recent_log_lines(lines: DataFrame, since: datetime, text: str = "value") -> DataFrame:
    """Lines whose leading timestamp is at or after ``since``; lines without one drop out."""
    stamp = F.try_to_timestamp(
        F.nullif(F.regexp_extract(text, LOG_TIME, 1), F.lit("")),
        F.lit("yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"),
    ).cast("timestamp_ntz")
    return lines.where(stamp >= ts_lit(since))


def _field(fields: Column, prefix: str) -> Column:
    """Last tab field with the prefix, kept only when it is valid JSON."""
    hits = F.filter(fields, lambda f: f.startswith(prefix))
    last = F.try_element_at(hits, F.lit(-1))
    return F.when(F.try_parse_json(last).isNotNull(), last)


def _sized_segments(json_text: Column) -> Column:
    """The JSON text with the list at ``intervals.segments`` replaced by its length."""
    everything = F.from_json(json_text, "map<string,variant>")
    intervals = F.from_json(
        F.get_json_object(json_text, "$.intervals"), "map<string,variant>"
    )
    size = F.size(
        F.from_json(F.get_json_object(json_text, "$.intervals.segments"), "array<variant>")
    )
    as_variant = F.parse_json(size.cast("string"))
    counted = F.transform_values(
        intervals, lambda k, v: F.when(k == "segments", as_variant).otherwise(v)
    )
    replaced = F.transform_values(
        everything,
        lambda k, v: F.when(k == "intervals", F.parse_json(F.to_json(counted))).otherwise(v),
    )
    has_segments = F.get_json_object(json_text, "$.intervals.segments").isNotNull()
    return F.when(has_segments, F.to_json(replaced)).otherwise(json_text)


def parse_query_log(lines: DataFrame, text: str = "value") -> DataFrame:
    """Distinct log lines as timestamp, query type, query and SQL time documents."""
    fields = F.split(F.col(text), "\t")
    distinct = lines.select(text).distinct()
    return distinct.select(
        F.element_at(fields, 1).alias("timestamp"),
        _sized_segments(_field(fields, '{"queryType":')).alias("queryType_json"),
        _field(fields, '{"query":').alias("query_json"),
        _field(fields, '{"sqlQuery/time":').alias("sqlquery_time"),
    )


# ---------------------------------------------------------------- notifications


def alert_rows(messages: DataFrame, text: str = "value") -> DataFrame:
    """One notification row per alert and recipient."""
    alert = decode(messages, ALERT, text).where(F.col("record").isNotNull()).select("record.*")
    level = severity(F.col("perceivedSeverity"), F.col("cleared"))
    raised = F.upper(F.coalesce("perceivedSeverity", F.lit(NO_INFORMATION)))
    icons = literal_map(SEVERITY_ICONS)
    subject = F.concat(
        F.coalesce(F.try_element_at(icons, raised), F.lit("")),
        F.lit(" "),
        raised,
        F.lit(" ALERTA: "),
        or_marker(F.col("alarmTypeName"), NO_INFORMATION),
        F.lit(" REGRA: "),
        or_marker(F.col("thresholdRuleName"), NO_INFORMATION),
    )
    when_raised = F.date_format(from_millis(F.col("alarmRaisedTime")), "yyyy-MM-dd HH:mm:ss")
    return alert.select(
        F.explode("sendToEmail.list").alias("recipient"),
        "alarmId",
        subject.alias("subject"),
        level.alias("severity"),
        F.try_element_at(icons, level).alias("icon"),
        F.try_element_at(literal_map(SEVERITY_COLOURS), level).alias("colour"),
        *[
            or_marker(F.col(c), NO_INFORMATION).alias(c)
            for c in ("alarmTypeName", "alarmedObjectName", "thresholdRuleName", "value")
        ],
        F.concat_ws(
            " ", or_marker(when_raised, NO_INFORMATION), F.coalesce("timeZone", F.lit(""))
        ).alias("raised"),
        F.when(F.col("eventType") == "x1", F.lit("ATIVO")).otherwise(F.lit("ENCERRADO")).alias(
            "event_status"
        ),
    )


def report_requests(messages: DataFrame, text: str = "value") -> DataFrame:
    """Report deliveries: recipients as a list, subject and attachment name from the key."""
    request = decode(messages, REPORT_REQUEST, text).where(F.col("record").isNotNull())
    bare = F.replace(
        F.replace(F.col("record.storekey"), F.col("record.exportFormat"), F.lit("")),
        F.lit("exports/"),
        F.lit(""),
    )
    return request.select(
        F.col("record.storekey").alias("storekey"),
        F.col("record.exportFormat").alias("exportFormat"),
        bracket_list(F.col("record.recipients")).alias("recipients"),
        bare.alias("subject"),
        attachment_name(bare).alias("attachment"),
        F.replace(F.col("record.storekey"), F.lit("exports/"), F.lit("")).alias("info"),
    )


# ---------------------------------------------------------------- inventory, charts, documents


def inventory_rows(
    landed: DataFrame, attributes: T.StructType, discovery: T.StructType, text: str = "value"
) -> DataFrame:
    """``attributes`` and ``discoveryAttributes`` of every node of landed inventory pages."""
    node = T.StructType(
        [
            T.StructField("attributes", attributes),
            T.StructField("discoveryAttributes", discovery),
        ]
    )
    page = T.StructType(
        [T.StructField("payLoad", T.StructType([T.StructField("nodes", T.ArrayType(node))]))]
    )
    parsed = landed.select(F.from_json(text, page).alias("p"))
    return parsed.select(F.explode("p.payLoad.nodes").alias("n")).select("n.*")


def _path(df: DataFrame, path: str) -> Column:
    """Nested column, or null when the schema has no such path."""
    schema: T.DataType = df.schema
    for part in path.split("."):
        if not isinstance(schema, T.StructType) or part not in schema.fieldNames():
            return F.lit(None).cast("string")
        schema = schema[part].dataType
    return F.col(".".join(f"`{p}`" for p in path.split(".")))


def map_fields(
    rows: DataFrame, mapping: Mapping[str, str], constants: Mapping[str, object]
) -> DataFrame:
    """Sections of mapped fields: ``section.field`` <- dotted path.

    ``section.*`` takes the whole ``discoveryAttributes`` struct; constants become columns.
    """
    sections: dict[str, dict[str, Column] | None] = {}
    for target, path in mapping.items():
        section, field = target.split(".")
        if field == "*":
            sections[section] = None
        elif sections.get(section, {}) is not None:
            sections.setdefault(section, {})[field] = _path(rows, path)
    columns = [
        F.col("discoveryAttributes").alias(name)
        if fields is None
        else F.struct(*[c.alias(f) for f, c in fields.items()]).alias(name)
        for name, fields in sections.items()
    ]
    return rows.select(*columns, *[F.lit(v).alias(k) for k, v in constants.items()])


def chart_rows(landed: DataFrame, schema: T.StructType, text: str = "value") -> DataFrame:
    """Data rows of the first result of a saved chart."""
    result = T.StructType([T.StructField("data", T.ArrayType(schema))])
    document = T.StructType([T.StructField("result", T.ArrayType(result))])
    parsed = landed.select(F.from_json(text, document).alias("d"))
    data = F.try_element_at("d.result", F.lit(1))["data"]
    return parsed.select(F.explode(data).alias("r")).select("r.*")


def index_documents(
    landed: DataFrame, date_paths: Mapping[str, str], start: datetime, end: datetime,
    excluded: Sequence[str] = (), text: str = "value",
) -> DataFrame:
    """Index documents of a closed time range, newest first.

    Every index names its own date field; ``date_paths`` maps an index name, or a prefix
    ending in ``*``, to the dotted path inside the document. The longest match decides.
    """
    # A generator parses every document once; the filters below work on its two texts.
    parsed = landed.select(F.json_tuple(text, "_index", "_source").alias("_index", "_source"))
    index = F.col("_index")
    dated = F.lit(None).cast("string")
    for pattern in sorted(date_paths, key=len):
        hit = (
            index.startswith(pattern[:-1]) if pattern.endswith("*") else index == F.lit(pattern)
        )
        path = "$" + "".join(f"['{p}']" for p in date_paths[pattern].split("."))
        dated = F.when(hit, F.get_json_object("_source", path)).otherwise(dated)
    rows = parsed.select("_index", "_source", F.explode(F.array(dated)).alias("__text"))
    return (
        rows.withColumn("date", parse_any_time(F.col("__text")))
        .where(F.col("date").between(ts_lit(start), ts_lit(end)) & ~index.isin(*excluded))
        .select("_index", "date", "_source")
        .orderBy(F.desc("date"))
    )


def element_rows(
    landed: DataFrame, parameters: T.DataType, owner: str, text: str = "value"
) -> DataFrame:
    """Active elements of landed element lists, each with its parameter list.

    ``owner`` is the field that names the agent an element belongs to.
    """
    element = T.StructType(
        [
            T.StructField("ID", T.LongType()),
            T.StructField(owner, T.LongType()),
            T.StructField("Name", T.StringType()),
            T.StructField("Type", T.StringType()),
            T.StructField("State", T.StringType()),
            T.StructField("Parameters", T.ArrayType(parameters)),
        ]
    )
    document = T.StructType([T.StructField("d", T.ArrayType(element))])
    parsed = landed.select(F.from_json(text, document).alias("doc"))
    return active_elements(parsed.select(F.explode("doc.d").alias("e")).select("e.*"))


def element_feeds(elements: DataFrame, owner: str) -> tuple[DataFrame, DataFrame]:
    """``(element feed, parameter feed)``; the second has one row per parameter."""
    feed = elements.drop("Parameters")
    parameters = elements.select(
        "ID", owner, F.explode("Parameters").alias("p")
    ).select("ID", owner, "p.*")
    return feed, parameters


# ---------------------------------------------------------------- files and SQL text


def list_files(
    spark: SparkSession, path: str, suffix: str, after: datetime | None = None,
    before: datetime | None = None,
) -> DataFrame:
    """Files under a folder by suffix and modification window; contents are never read."""
    reader = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", f"*{suffix}")
    )
    if after:
        reader = reader.option("modifiedAfter", after.strftime("%Y-%m-%dT%H:%M:%S"))
    if before:
        reader = reader.option("modifiedBefore", before.strftime("%Y-%m-%dT%H:%M:%S"))
    return reader.load(path).select(
        "path",
        F.regexp_extract("path", r"([^/]+)$", 1).alias("managerFilename"),
        F.col("modificationTime").cast("timestamp_ntz").alias("mtime"),
        "length",
    )


def run_stored_query(
    spark: SparkSession, text: str, start: datetime, tables: Mapping[str, DataFrame]
) -> DataFrame:
    """Stored SQL text over the given tables; ``:start`` stands for the start time.

    Tables are named ``{name}`` in the text; the start time is bound as a parameter.
    """
    return spark.sql(text, args={"start": start.strftime("%Y-%m-%d %H:%M:%S.%f")}, **tables)


def default_start(now: datetime, mark: datetime | None) -> datetime:
    """Stored high-water mark, or a day back on the first run."""
    return mark if mark is not None else now - timedelta(hours=24)
