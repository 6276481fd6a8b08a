import zlib

import pytest
from pyspark.sql import functions as F

from helpers import LONG, documents, prose
from wavemeter.llm.prefix import running_sums, value_blocks
from wavemeter.llm.shards import op6_byte_shards, shard_by_bytes


def check(rows, out, shards):
    expected = sorted(
        ((i is not None, i or 0, zlib.crc32((t or "").encode()), len((t or "").encode()) + 8) for i, t in rows)
    )
    total, before, slots, named = sum(r[3] for r in expected), 0, {}, []
    for known, i, crc, size in expected:
        shard = min(shards - 1, (2 * before + size) * shards // (2 * total))
        before += size
        slots[shard] = slots.get(shard, -1) + 1
        named.append((i if known else None, size, crc, shard, slots[shard]))
    got = sorted(tuple(r[c] for c in ("doc_id", "size", "text_crc32", "shard", "slot")) for r in out if r["doc_id"] is not None)
    assert got == sorted(r for r in named if r[0] is not None)
    assert len(out) == len(rows)


@pytest.mark.parametrize("shards, blocks", [(24, 16), (3, 1), (5, 1000)])
def test_against_one_pass(spark, shards, blocks):
    rows = [(n * 7 % 501, prose(n, n % 40)) for n in range(500)] + [(3, "x"), (3, "x"), (None, "z"), (-5, None), (10**15, "")]
    check(rows, shard_by_bytes(documents(spark, rows), shards, blocks).collect(), shards)


def test_one_huge_text_and_empty(spark):
    rows = [(1, "a"), (2, LONG), (3, "é")]
    check(rows, shard_by_bytes(documents(spark, rows), 4).collect(), 4)
    assert shard_by_bytes(documents(spark, []), 4).count() == 0


def test_running_sums_within_groups(spark):
    df = spark.range(300).select((F.col("id") % 3).alias("g"), F.col("id").alias("v"), F.lit(2).alias("a"))
    df = df.withColumn("g", F.when(F.col("g") > 0, F.col("g")))
    out = running_sums(df.withColumn("b", value_blocks(df, "v", 9)), ["g"], "b", ["v"], "a").collect()
    for r in out:
        assert (r["before"], r["place"], r["total"], r["rows"]) == (r["v"] // 3 * 2, r["v"] // 3, 200, 100)


def test_driver_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    out = op6_byte_shards(spark, sf).collect()
    check([(r["doc_id"], r["text"]) for r in docs], out, 24)
    assert {r["law"] for r in out} == {"bytes"} and {r["grown_shard"] for r in out} == {None}
