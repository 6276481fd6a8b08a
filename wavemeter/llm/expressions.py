"""Column helpers that the native operators share."""

from __future__ import annotations

import re
import tempfile
import uuid
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The white space that separates words, as characters and as a class.
SPACES = " \t\n\x0b\x0c\r"
SPACE_CLASS = "[\\x20\\x09-\\x0D]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use it many times in ``body``.

    A lambda that names an outer expression would evaluate it for every element.
    """
    return F.transform(F.array(value), body)[0]


def text_of(column: Column) -> Column:
    """The text, empty where it is null."""
    return F.coalesce(column.cast("string"), F.lit(""))


def words(text: Column) -> Column:
    """Array of the words of a text, in order."""
    return let(
        F.btrim(text, F.lit(SPACES)),
        lambda t: F.when(F.length(t) == 0, F.array().cast("array<string>")).otherwise(
            F.split(t, SPACE_CLASS)
        ),
    )


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def has_word(text: Column) -> Column:
    return F.length(F.btrim(text, F.lit(SPACES))) > 0


def occurrences(text: Column, characters: str) -> Column:
    """How many of these single characters a text holds."""
    return F.regexp_count(text, F.lit("[" + re.escape(characters) + "]"))


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see, from ``spark.checkpoint.dir``; on a local master a
    temporary one, because there every task sees the same disk."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.conf.get("spark.master", "local").startswith(("local[", "local")) or spark.conf.get(
        "spark.master", "local"
    ).startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
    root = tempfile.mkdtemp(prefix="llm-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


# Spark's own setting to remove the shuffle files of a query when it ends.
RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, purpose: str, release: bool = False) -> DataFrame:
    """Write a frame to the shared folder and read it back: cuts the lineage, survives executors.

    With ``release`` the shuffles behind it are removed once it is written, as nothing reads them again.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"
    before = spark.conf.get(RELEASE, "false")
    try:
        if release:
            spark.conf.set(RELEASE, "true")
        df.write.parquet(path)
    finally:
        if release:
            spark.conf.set(RELEASE, before)
    return spark.read.schema(df.schema).parquet(path)


def zero() -> Column:
    return F.lit(0).cast("long")


# Most numbers (8 bytes each) of a list that is broadcast.
SHORT_LIST = 1_000_000


def short_list(keys: DataFrame) -> DataFrame:
    """A list of numbers, marked for broadcast if counted to be short. A longer one is
    joined by shuffle, with the same result."""
    return F.broadcast(keys) if keys.limit(SHORT_LIST + 1).count() <= SHORT_LIST else keys


_shipped: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Send the helpers that tasks import to the Python workers, once per application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    here = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="llm-code-")) / "llm-code.zip"
    with zipfile.ZipFile(archive, "w") as out:
        out.write(here.parent / "__init__.py", f"{here.parent.name}/__init__.py")
        for file in sorted(here.glob("*.py")):
            out.write(file, f"{here.parent.name}/{here.name}/{file.name}")
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)
