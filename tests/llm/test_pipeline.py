import base64
import hashlib
import re

import public_tokenizers
import tiktoken
from pyspark.sql import functions as F

import brute
import corpus_pipeline
from helpers import documents
from wavemeter.llm.secrets import secret_spans


def library():
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def masked(text, spans):
    out, at = [], 0
    for start, stop in spans:
        if start >= at:
            out += [text[at:start], "[SECRET]"]
            at = stop
        else:
            at = max(at, stop)
    return "".join(out) + text[at:]


def domain(source):
    n = re.fullmatch("src([0-9]{1,9})", source or "")
    return ("web", "news", "books", "talk")[int(n[1]) % 4] if n else "other"


def test_stages_have_the_agreed_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "jaccard_join", "secret_scan", "source_mix", "byte_bpe"]


def test_against_plain(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    rows = [r for r in docs if brute.quality_kept(r["text"])]
    parts = brute.jaccard_components([(r["doc_id"], r["text"]) for r in rows])
    rows = [r for r in rows if parts[r["doc_id"]][1] == r["doc_id"]]
    # Spans are the scan's own; its base ones are held against brute force in test_secrets.
    kept = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    found = {r["doc_id"]: [(s["start"], s["stop"]) for s in r["secrets"]] for r in secret_spans(kept).collect()}
    texts = {r["doc_id"]: masked(r["text"], found[r["doc_id"]]) for r in rows}
    plain = [(r["doc_id"], (domain(r["source"]), r["lang"], r["source"]), len(brute.WORD.findall(texts[r["doc_id"]]))) for r in rows]
    mix = corpus_pipeline.MIX
    chosen = brute.mix(plain, dict(mix.weights), mix.share, mix.epochs, mix.seed)
    coder = library()
    expected = set()
    for key, _ in chosen:
        ids = coder.encode_ordinary(texts[key])
        listed = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        expected.add((key, len(ids), listed, hashlib.sha256(texts[key].encode()).hexdigest()))
    got = corpus_pipeline.run(spark, sf).collect()
    assert {tuple(r) for r in got} == expected and len(got) == len(expected)


def test_stages_keep_columns_and_bear_odd_rows(spark):
    docs = documents(spark, [(1, None), (None, "x"), (2, ""), (3, "token = abcdefgh. " * 30), (3, "token = abcdefgh. " * 30)])
    for table in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, table, "")
            assert out.columns == docs.columns
            out.collect()
        assert corpus_pipeline.STAGES[-1][1](spark, table, "").count() == table.count()


def test_secrets_are_gone(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = corpus_pipeline.secrets(spark, docs, sf)
    left = out.select(F.col("n_chars") == F.length("text"), "text").collect()
    assert all(r[0] and not brute.secret_base(r[1]) for r in left)
