import math
import re
import zlib
from collections import Counter, defaultdict

import pytest
import regex
from helpers import LONG, documents
from wavemeter.llm.languages import STEPS, Fit, identify, learn, op11_language_id


def plain_model(rows, fit):
    """Scores by key for words and for each gram length, from counters."""
    words = Counter()
    for text, lang in rows:
        if text is not None and lang is not None:
            words.update((w, lang) for w in regex.split(r"[^\p{L}\p{M}]+", text.lower()) if w)
    grams = Counter()
    for (word, lang), n in words.items():
        edged = f"_{word}_"
        for k in range(1, fit.order + 1):
            for i in range(len(edged) - k + 1):
                grams[edged[i : i + k], lang] += n
    totals = Counter()
    for (_, lang), n in words.items():
        totals[lang] += n
    langs = sorted(totals, key=lambda x: (-totals[x], x))

    def chosen(counts, capacity):
        total, of = Counter(), defaultdict(dict)
        for (key, lang), n in counts.items():
            total[key] += n
            of[key][lang] = n
        steps = Counter()
        for key, n in total.items():
            steps[math.floor(math.log2(n) * STEPS)] += len(of[key])
        held, cut = 0, math.inf
        for step in sorted(steps, reverse=True):
            held += steps[step]
            if held > capacity:
                break
            cut = step
        return {k: of[k] for k, n in total.items() if math.floor(math.log2(n) * STEPS) >= cut}

    def scored(held, sums):
        return {
            key: [round(1000 * math.log((of.get(x, 0) + 0.5) / (sums[x] + 0.5 * max(1, len(held))))) for x in langs]
            for key, of in held.items()
        }

    held = chosen(grams, fit.grams)
    tables = [scored(chosen(words, fit.words), totals)]
    for k in range(1, fit.order + 1):
        sums = Counter()
        for (gram, lang), n in grams.items():
            if len(gram) == k:
                sums[lang] += n
        tables.append(scored({g: of for g, of in held.items() if len(g) == k}, sums))
    return langs, tables


def plain_judge(model, text, fit):
    langs, tables = model
    if text is None or not regex.search(r"\p{L}", text) or not langs:
        return "und", 0.0
    total, n = [0] * len(langs), 0
    for word in regex.split(r"[^\p{L}\p{M}]+", text.lower()):
        if not word:
            continue
        n += 1
        scores = tables[0].get(word)
        for k in range(fit.order, 0, -1):
            if scores:
                break
            grams = [f"_{word}_"[i : i + k] for i in range(len(word) + 3 - k)]
            known = [tables[k][g] for g in grams if g in tables[k]]
            scores = [round(sum(c) / len(known)) for c in zip(*known, strict=True)] if known else None
        total = [a + b for a, b in zip(total, scores or [0] * len(langs), strict=True)]
    best = max(range(len(langs)), key=lambda i: (total[i], -i))
    return langs[best], 1 / sum(math.exp((x - total[best]) / (1000 * max(n, 1))) for x in total)


@pytest.mark.parametrize("fit", [Fit(), Fit(words=300, grams=2000), Fit(words=0, grams=500, order=3), Fit(words=50, grams=0)])
def test_equals_plain_version(spark, sf, fit):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang")
    rows = docs.collect()
    model = plain_model([(r["text"], r["lang"]) for r in rows if r["doc_id"] % 2], fit)
    found = identify(docs, learn(docs.filter("doc_id % 2 = 1"), fit)).collect()
    want = {r["doc_id"]: plain_judge(model, r["text"], fit) for r in rows}
    for r in found:
        lang, score = want[r["doc_id"]]
        assert r["lang_pred"] == lang and r["score"] == pytest.approx(score, abs=1e-3)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    found = op11_language_id(spark, sf).collect()
    assert {r["doc_id"] for r in found} == set(truth)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in found)
    held = [r for r in found if r["held_out"] and truth[r["doc_id"]] is not None and r["lang_pred"] != "und"]
    assert len(held) > 200
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in found)


TAUGHT = [(i, t) for i, t in enumerate(["the house of the king", "das Haus des Königs", None, "", "12 34"] * 3)]


def taught(spark):
    docs = documents(spark, TAUGHT).withColumnRenamed("lang", "old")
    return docs.selectExpr("*", "case when doc_id % 5 = 1 then 'de' when doc_id % 5 = 2 then null else 'en' end as lang")


def test_defined_cases(spark):
    model = learn(taught(spark))
    rows = [
        (1, None), (2, ""), (3, "12 _ 34 !"), (4, "The King"), (4, "The King"), (5, "KÖNIGE hausten"), (6, LONG),
        (7, "ЖЖЖ"), (None, "das Haus"), (8, "́"), (9, "the " + "x" * 100_000),
    ]
    out = sorted(((r["doc_id"] or 0, r["lang_pred"], r["score"]) for r in identify(documents(spark, rows), model).collect()))
    assert [x[:2] for x in out if x[0] in (1, 2, 3, 8)] == [(1, "und"), (2, "und"), (3, "und"), (8, "und")]
    named = dict(x[:2] for x in out)
    assert named[4] == "en" and named[5] == "de" and named[0] == "de" and named[7] == "en" and named[9] == "en"
    assert len([x for x in out if x[0] == 4]) == 2
    assert identify(documents(spark, []), model).count() == 0


def test_nothing_to_learn_from(spark):
    model = learn(taught(spark).filter("false"))
    assert [tuple(r)[1:] for r in identify(documents(spark, [(1, "the house")]), model).collect()] == [("und", 0.0)]


def test_only_the_text_decides(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = learn(docs)
    a = {r["doc_id"]: r["lang_pred"] for r in identify(docs, model).collect()}
    b = {r["doc_id"]: r["lang_pred"] for r in identify(docs.selectExpr("doc_id", "text", "'xx' as lang"), model).collect()}
    assert a == b and re.fullmatch("[a-z]{2,3}", next(iter(a.values())))
