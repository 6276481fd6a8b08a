"""Row-level expressions: labels, templates, text clean-up, status and notification fields."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Notification colours and icons per severity.
SEVERITY_ICONS = {
    "CLEAR": "🟢",
    "WARNING": "🔵",
    "MINOR": "🟡",
    "MAJOR": "🟠",
    "CRITICAL": "🔴",
    "Sem informação": "⚪",
}
SEVERITY_COLOURS = {
    "CLEAR": "#00FF00",
    "WARNING": "#3399FF",
    "MINOR": "#FFFF00",
    "MAJOR": "#FFA500",
    "CRITICAL": "#FF0000",
    "Sem informação": "#ffffff",
}
NO_INFORMATION = "Sem informação"

# Accented Latin letters and their base letters, position by position.
_ACCENTED = "àáâãäåçèéêëìíîïñòóôõöùúûüýÿÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÑÒÓÔÕÖÙÚÛÜÝ"
_PLAIN = "aaaaaaceeeeiiiinooooouuuuyyAAAAAACEEEEIIIINOOOOOUUUUY"


def literal_map(table: Mapping[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in table.items() for x in kv])


def suffixed(name: Column, *suffixes: str) -> Column:
    return F.concat(name, *[F.lit(s) for s in suffixes])


def joined_distinct(value: str | Column, sep: str = ",") -> Column:
    """Distinct values of a group as one text, in a fixed order."""
    return F.array_join(F.sort_array(F.collect_set(value)), sep)


def fill_template(template: Column, labels: Column) -> Column:
    """Replace every ``<key>`` of the template by its label; a missing label gives ``null``."""
    names = F.array_distinct(F.regexp_extract_all(template, F.lit("<(.*?)>"), F.lit(1)))
    return F.aggregate(
        names,
        template,
        lambda text, name: F.replace(
            text,
            F.concat(F.lit("<"), name, F.lit(">")),
            F.coalesce(F.try_element_at(labels, name), F.lit("null")),
        ),
    )


def classify(text: Column, rules: Mapping[str, str], default: str) -> Column:
    """First rule whose key occurs in the text, ignoring case, wins."""
    lowered = F.lower(text)
    choices = [F.when(lowered.contains(k.lower()), F.lit(v)) for k, v in rules.items()]
    return F.coalesce(*choices, F.lit(default))


def epoch_minute(seconds: Column) -> Column:
    return (F.floor(seconds / 60) * 60).cast("long")


def clean_dn(dn: Column) -> Column:
    """Stored element names carry ``$$`` for commas and stray double quotes."""
    return F.replace(F.replace(dn, F.lit("$$"), F.lit(",")), F.lit('"'), F.lit(""))


def spatial_dn(metric_id: Column, metric_name: Column, level: Column, slice_: Column) -> Column:
    return F.concat_ws(
        "-", *[F.coalesce(c, F.lit("")) for c in (metric_id, metric_name, level, slice_)]
    )


def attachment_name(name: Column) -> Column:
    """Lower-case file name without accents or spaces."""
    plain = F.translate(name, _ACCENTED, _PLAIN)
    return F.lower(F.replace(F.regexp_replace(plain, r"\p{M}", ""), F.lit(" "), F.lit("_")))


def split_addresses(text: Column, sep: str = ";") -> Column:
    """Non-empty, trimmed entries of an address list."""
    return F.filter(F.transform(F.split(text, sep), lambda x: F.trim(x)), lambda x: x != "")


def offline_hours(last_seen: Column, now: Column) -> Column:
    seconds = F.unix_micros(now.cast("timestamp")) - F.unix_micros(last_seen.cast("timestamp"))
    return F.round(seconds / F.lit(3_600_000_000), 3)


def liveness(hours: Column, limit: float = 1.0) -> Column:
    return F.when(hours <= F.lit(limit), F.lit("ONLINE")).otherwise(F.lit("OFFLINE"))


def severity(perceived: Column, cleared: Column) -> Column:
    known = F.upper(F.coalesce(perceived, F.lit(NO_INFORMATION)))
    known = F.when(known == NO_INFORMATION.upper(), F.lit(NO_INFORMATION)).otherwise(known)
    return F.when(F.coalesce(cleared, F.lit(False)), F.lit("CLEAR")).otherwise(known)


def bracket_list(text: Column) -> Column:
    """``[a,b]`` text as an array."""
    return F.split(F.trim(text, F.lit("[]")), ",")


def any_contains(columns: list[Column], tag: str) -> Column:
    texts = F.array(*[c.cast("string") for c in columns])
    return F.coalesce(F.exists(texts, lambda x: x.contains(tag)), F.lit(False))


def literal_text(value: Column) -> Column:
    """Text forms of missing values become null: ``None``."""
    return F.nullif(value, F.lit("None"))


def literal_boolean(value: Column) -> Column:
    """``True`` / ``False`` text as boolean, anything else null."""
    return F.when(value == "True", F.lit(True)).when(value == "False", F.lit(False))


def or_marker(value: Column, marker: str) -> Column:
    return F.coalesce(value, F.lit(marker))


def quoted_list(sql_text: Column, column: str) -> Column:
    """Items of ``"column" IN ('a', 'b')`` found in a piece of SQL text; empty if absent."""
    body = F.regexp_extract(sql_text, rf'"?{column}"? IN\s*\(([\s\S]*?)\)', 1)
    items = F.transform(F.split(body, ","), lambda x: F.trim(x, F.lit("' ")))
    return F.filter(items, lambda x: x != "")


def quoted_equals(sql_text: Column, column: str) -> Column:
    """The text compared with ``"column"`` by equality; null if absent."""
    return F.nullif(F.regexp_extract(sql_text, rf"\"{column}\" = '(.*?)'", 1), F.lit(""))


def quoted_times(sql_text: Column) -> Column:
    return F.regexp_extract_all(sql_text, F.lit(r"TIME_PARSE\('(.*?)'\)"), F.lit(1))


def bracketed_lists(sql_text: Column) -> Column:
    return F.regexp_extract_all(sql_text, F.lit(r"\[(.*?)\]"), F.lit(1))


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))
