import pytest
from pyspark.sql import functions as F

import brute
from helpers import LONG, documents
from wavemeter.llm.expressions import text_of, word_count
from wavemeter.llm.mixing import PRODUCTION, Mix, mix_sources, op10_source_mix

SCHEMA = "doc_id long, domain string, lang string, tokens long, budget long, epoch int, _x int"


def compare(spark, rows, mix):
    df = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], SCHEMA)
    out = mix_sources(df, {"domain": df.domain, "lang": df.lang}, df.tokens, mix)
    plain = [(i, (d or "", g or ""), t or 0) for i, d, g, t in rows]
    expected = brute.mix(plain, dict(mix.weights), mix.share, mix.epochs, mix.seed)
    assert sorted(((r["doc_id"], r["epoch"]) for r in out.collect()), key=str) == expected


def table(n):
    rows = []
    for i in range(n):
        domain = "hot" if i % 3 == 0 else f"d{i % 4}"
        rows.append((i, domain, ("en", "de", "fr")[i % 5 % 3], i * 37 % 101))
    return rows


@pytest.mark.parametrize(
    "mix",
    [
        Mix(),
        Mix(weights={("hot",): 5, ("d1",): 2, ("hot", "en"): 3, ("d2", "de"): 0}, share=(1, 2), epochs=2, seed="s"),
        Mix(weights={("d3",): 50}, share=(9, 10), epochs=1),
        Mix(weights={("hot",): 0}, share=(1, 1), epochs=3),
        Mix(share=(0, 1)),
    ],
)
def test_against_plain(spark, mix):
    compare(spark, table(400), mix)


def test_shortage_goes_to_siblings_first(spark):
    rows = [(1, "a", "x", 10), *((10 + i, "a", "y", 10) for i in range(20)), *((100 + i, "b", "z", 10) for i in range(40))]
    df = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], SCHEMA)
    out = mix_sources(df, {"domain": df.domain, "lang": df.lang}, df.tokens, Mix(share=(200, 610)))
    spent = {(r["domain"], r["lang"]): r["n"] for r in out.groupBy("domain", "lang").agg(F.sum("n_tokens").alias("n")).collect()}
    assert spent == {("a", "x"): 10, ("a", "y"): 90, ("b", "z"): 100}


def test_odd_rows(spark):
    rows = [(None, None, "en", 5), (1, "a", None, None), (2, "a", None, 0), (3, "a", "en", 7), (3, "a", "en", 7), (4, "b", "en", 10**9)]
    compare(spark, rows, Mix(share=(1, 1), epochs=2))
    compare(spark, [], Mix())
    compare(spark, [(1, "a", "en", 0)], Mix(share=(1, 1)))


def test_kept_columns(spark):
    docs = documents(spark, [(1, "a b"), (2, LONG), (None, None), (3, "c")])
    levels = {"_a": docs.lang, "_b": docs.source}
    out = mix_sources(docs, levels, word_count(text_of(docs.text)), Mix(share=(1, 1)), keep=docs.columns)
    assert sorted(map(str, out.select(*docs.columns).collect())) == sorted(map(str, docs.collect()))


def test_driver_table(spark, sf):
    def domain(source):
        n = source.removeprefix("src")
        return ("web", "news", "books", "talk")[int(n) % 4] if n.isdigit() else "other"

    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    plain = [(r["doc_id"], (domain(r["source"]), r["lang"], r["source"]), len(brute.WORD.findall(r["text"]))) for r in docs]
    expected = brute.mix(plain, dict(PRODUCTION.weights), PRODUCTION.share, PRODUCTION.epochs, PRODUCTION.seed)
    got = sorted(((r["doc_id"], r["epoch"]) for r in op10_source_mix(spark, sf).collect()), key=str)
    assert got == expected
