"""Contiguous shards of near-equal bytes from prefix sums of block totals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wavemeter.llm.expressions import stored, text_of
from wavemeter.llm.prefix import running_sums, value_blocks


def shard_by_bytes(
    docs: DataFrame, shards: int = 24, blocks: int = 1024, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per document: its id, ``size``, ``text_crc32``, ``shard`` and ``slot``.

    Documents are ordered by id (nulls first), then checksum and size, so ties have one order and
    repeated rows follow each other. A document belongs to the shard in which the middle of its
    bytes falls when all bytes are cut into equal parts, so a shard is off by one document's size
    at most. ``slot`` counts from 0 in a shard. A null text has no bytes and counts as 8 like an
    empty one. An empty table gives no rows; other columns are ignored. Texts are read once; only
    (id, size, checksum) is shuffled, and is stored before the cuts so all passes see one state.
    """
    whole = text_of(docs[text])
    slim = stored(
        docs.select(
            docs[key].alias("key"),
            (F.octet_length(whole) + 8).cast("long").alias("size"),
            F.crc32(whole).alias("text_crc32"),
        ),
        "shard-sizes",
    )
    blocked = slim.withColumn("block", value_blocks(slim, "key", blocks))
    placed = running_sums(blocked, [], "block", ["key", "text_crc32", "size"], "size")
    cut = placed.withColumn(
        "shard",
        F.least(
            F.lit(shards - 1), F.expr(f"((2 * before + size) * {shards}) div (2 * total)")
        ).cast("int"),
    )
    starts = cut.groupBy(F.col("shard").alias("of")).agg(F.min("place").alias("first"))
    # One row for each shard.
    return cut.join(F.broadcast(starts), F.col("shard") == F.col("of")).select(
        F.col("key").alias(key),
        "size",
        "text_crc32",
        "shard",
        (F.col("place") - F.col("first")).cast("long").alias("slot"),
    )


def op6_byte_shards(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return shard_by_bytes(docs).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
