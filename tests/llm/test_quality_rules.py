from brute import quality_base, quality_kept
from helpers import LONG, documents, prose
from wavemeter.llm.quality import keep_good, op4_quality_rules, quality_rules

TEXTS = [
    None, "", " \t\n", "one two", "a b c a b c a b c", "a a a a a", "x\ny\nx\n\n \n x\nx",
    "# a | b > c $ % & *\n" * 5, "\x0b\x0cw\r\nw", "é 😀 é 😀 é 😀", " nb sp em sp ",
    prose(1, 80) + ".", prose(2, 80), "\n".join(prose(i, 30) + "." for i in range(5)), LONG,
    " | ".join(prose(3, 100).split()) + ".", " ".join(w + "!!" for w in prose(4, 90).split()),
    " ".join(w + "***" for w in prose(5, 90).split()) + ".", prose(6, 60) + ".\nAll rights reserved.\nhome > about > log in.",
]


def test_counts_and_verdicts(spark):
    docs = documents(spark, list(enumerate(TEXTS)))
    out = quality_rules(docs).select("doc_id", "quality.*").collect()
    assert len(out) == len(TEXTS)
    for r in out:
        text = TEXTS[r["doc_id"]]
        counted = tuple(
            r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
        )
        assert counted == quality_base(text), text and text[:50]
        assert r["kept"] == quality_kept(text), text and text[:50]


def test_lines_removed(spark):
    text = prose(6, 60) + ".\nAll rights reserved.\nhome > about > log in\n" + prose(7, 20) + "."
    r = quality_rules(documents(spark, [(1, text)])).select("quality.*").first()
    assert r["n_failed_lines"] == 2 and r["kept"]
    assert r["clean_text"] == prose(6, 60) + ".\n" + prose(7, 20) + "."


def test_keep_good_leaves_columns(spark):
    good = prose(1, 80) + "."
    docs = documents(spark, [(1, good), (2, "junk"), (3, good), (3, good), (None, None)])
    kept = keep_good(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 3, 3]
    assert keep_good(docs.limit(0)).count() == 0


def test_driver_table(spark, sf):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in op4_quality_rules(spark, sf).collect():
        assert (r["n_words"], r["base_failed"]) == quality_base(texts[r["doc_id"]])[::5]
        assert r["kept"] == quality_kept(texts[r["doc_id"]])
