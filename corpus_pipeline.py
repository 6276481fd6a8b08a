"""The corpus pipeline: every stage reads what the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wavemeter.llm.bpe import digests
from wavemeter.llm.expressions import stored, text_of, word_count
from wavemeter.llm.jaccard import jaccard_join, same_components
from wavemeter.llm.mixing import Mix, mix_sources, source_domain
from wavemeter.llm.quality import keep_good
from wavemeter.llm.secrets import redact

MIX = Mix(
    weights={("web",): 3, ("news",): 2, ("books",): 4, ("talk",): 1, ("web", "en"): 2},
    share=(9, 10),
    epochs=1,
    seed="pipeline-1",
)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the line and document rules."""
    return keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of every group that links at three quarters or more."""
    return same_components(docs, jaccard_join(docs))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets masked and their lengths brought up to date."""
    return redact(docs, length="n_chars")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The prefix of every domain, language and source that its budget buys."""
    levels = {"_domain": source_domain(docs.source), "_lang": docs.lang, "_source": docs.source}
    mixed = mix_sources(docs, levels, word_count(text_of(docs.text)), MIX, keep=docs.columns)
    return mixed.select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the bytes read back from them."""
    import public_tokenizers

    return digests(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("quality_rules", quality),
    ("jaccard_join", near_duplicates),
    ("secret_scan", secrets),
    ("source_mix", mix),
    ("byte_bpe", encode),
]

# Digests of masked texts and byte-pair ids are beyond SQL; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
