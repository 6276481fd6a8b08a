"""Line-first quality rules, as column expressions only."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wavemeter.llm.expressions import SPACE_CLASS, SPACES, has_word, let, occurrences, text_of, words, zero

# Characters that count as symbols, and phrases of page furniture.
SYMBOLS = "#*$%&|<>"
BOILERPLATE = (
    "accept cookies",
    "all rights reserved",
    "click here",
    "cookie policy",
    "enable javascript",
    "log in",
    "lorem ipsum",
    "privacy policy",
    "sign in",
    "sign up",
    "subscribe to our newsletter",
    "terms of service",
    "terms of use",
)
NAVIGATION = "|>»›•·"
SENTENCE_END = ".!?…。！？"
CLOSING = "\"')]»”’"


@dataclass(frozen=True)
class LineRules:
    """Shares are of the words of a line, the last of the characters in words of a document."""

    symbol_share: float = 0.3
    shout_share: float = 0.5
    navigation_share: float = 0.2
    boilerplate_chars: int = 200
    lost_share: float = 0.5


def repeated_words(tokens: Column) -> Column:
    """Words that lie in a three-word window found twice or more.

    The hashes of a text's windows are sorted, so neighbours show the repeated ones. Only a text
    that has some sorts them with their places, which are then summed as overlapping intervals.
    """

    def hashes(ws: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.size(ws) - 3),
            lambda i: F.xxhash64(F.get(ws, i), F.get(ws, i + 1), F.get(ws, i + 2)),
        )

    def repeated_places(windows: Column) -> Column:
        return F.filter(
            F.transform(
                windows,
                lambda w, k: F.when(
                    ((k > 0) & (F.get(windows, k - 1)["hash"] == w["hash"]))
                    | F.coalesce(F.get(windows, k + 1)["hash"] == w["hash"], F.lit(False)),
                    w["place"],
                ),
            ),
            lambda place: place.isNotNull(),
        )

    def covered(places: Column) -> Column:
        return F.aggregate(
            F.sort_array(places),
            F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("total")),
            lambda state, place: F.struct(
                place.alias("last"),
                (state["total"] + F.least(F.lit(3), place - state["last"])).alias("total"),
            ),
            lambda state: state["total"],
        )

    def counted(found: Column) -> Column:
        placed = F.transform(found, lambda h, i: F.struct(h.alias("hash"), i.alias("place")))
        return F.when(F.size(F.array_distinct(found)) == F.size(found), zero()).otherwise(
            covered(let(F.sort_array(placed), repeated_places))
        )

    return F.when(F.size(tokens) < 3, zero()).otherwise(let(hashes(tokens), counted))


def line_failure(line: Column, rules: LineRules) -> Column:
    """The first rule that a line with words breaks, or null."""
    phrases = "(?i)(?:^|[^A-Za-z0-9_])(?:" + "|".join(BOILERPLATE).replace(" ", SPACE_CLASS) + ")(?:[^A-Za-z0-9_]|$)"
    marks = "[" + re.escape(SYMBOLS + NAVIGATION) + "!?]"

    def by_marks(t: Column) -> Column:
        return let(
            F.size(words(t)),
            lambda n: F.when(occurrences(t, SYMBOLS) > rules.symbol_share * n, "symbols")
            .when(
                (occurrences(t, NAVIGATION) >= 3) & (occurrences(t, NAVIGATION) > rules.navigation_share * n),
                "navigation",
            )
            .when(occurrences(t, "!?") > rules.shout_share * F.greatest(n, F.lit(4)), "shouting"),
        )

    def judged(t: Column) -> Column:
        ending = F.right(F.rtrim(t, F.lit(CLOSING)), F.lit(1))
        return F.coalesce(
            F.when(t.rlike(marks), by_marks(t)),
            F.when((F.length(t) <= rules.boilerplate_chars) & t.rlike(phrases), "boilerplate"),
            F.when(~ending.isin(*SENTENCE_END), "punctuation"),
        )

    return let(F.btrim(line, F.lit(SPACES)), judged)


def assess(text: Column, rules: LineRules = LineRules()) -> Column:
    """Struct of counts, cleaned text and verdict of one text.

    Fields: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_failed_lines,
    lost_chars (characters in words of the lines removed), clean_text (the lines left),
    base_failed, kept. A null or empty text has no words, so it fails; white space only likewise.
    Lines without a word are neither judged nor lost.
    """

    def letters(ws: Column) -> Column:
        return F.aggregate(ws, zero(), lambda total, word: total + F.length(word))

    def of_lines(t: Column, all_lines: Column, ws: Column) -> Column:
        fails = F.transform(all_lines, lambda line: has_word(line) & line_failure(line, rules).isNotNull())
        worded = F.filter(all_lines, has_word)
        return let(
            fails,
            lambda bad: F.struct(
                F.size(ws).cast("long").alias("n_words"),
                letters(ws).alias("word_chars"),
                occurrences(t, SYMBOLS).cast("long").alias("n_symbols"),
                let(worded, lambda w: F.size(w) - F.size(F.array_distinct(w))).cast("long").alias("n_dup_lines"),
                repeated_words(ws).alias("n_repeat_words"),
                F.size(worded).cast("long").alias("n_lines"),
                F.size(F.filter(bad, lambda b: b)).cast("long").alias("n_failed_lines"),
                F.aggregate(
                    F.filter(all_lines, lambda _, i: F.get(bad, i)),
                    zero(),
                    lambda total, line: total + letters(words(line)),
                ).alias("lost_chars"),
                F.array_join(F.filter(all_lines, lambda _, i: ~F.get(bad, i)), "\n").alias("clean_text"),
            ),
        )

    def verdict(s: Column) -> Column:
        failed = (s["n_words"] < 50) | (100 * s["n_repeat_words"] > 50 * s["n_words"])
        kept = ~failed & (s["lost_chars"] <= rules.lost_share * s["word_chars"])
        names = (
            "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
            "n_lines", "n_failed_lines", "lost_chars", "clean_text",
        )
        return F.struct(
            *(s[name].alias(name) for name in names), failed.alias("base_failed"), kept.alias("kept")
        )

    return let(
        text_of(text),
        lambda t: let(
            F.split(t, "\n", -1),
            lambda lines: let(words(t), lambda ws: let(of_lines(t, lines, ws), verdict)),
        ),
    )


def quality_rules(docs: DataFrame, text: str = "text", rules: LineRules = LineRules(), into: str = "quality") -> DataFrame:
    """Add the assessment of every row as struct ``into``; rows and other columns stay as they are.

    Copies and repeated rows are judged alike, each on its own; an empty table stays empty.
    """
    return docs.withColumn(into, assess(docs[text], rules))


def keep_good(docs: DataFrame, text: str = "text", rules: LineRules = LineRules()) -> DataFrame:
    """Only the rows that pass, with their columns and whole text unchanged."""
    return docs.filter(assess(docs[text], rules)["kept"])


def op4_quality_rules(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return quality_rules(docs).select(
        "doc_id",
        *(f"quality.{n}" for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")),
        "quality.base_failed",
        "quality.kept",
        "quality.n_lines",
        "quality.n_failed_lines",
        "quality.lost_chars",
    )
