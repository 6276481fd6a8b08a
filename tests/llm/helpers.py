"""Frames that tests share."""

import random

LONG = ("alpha beta gamma delta. " * 40_000).strip()


def documents(spark, rows):
    """Documents with extra columns whose names the operators use inside."""
    full = [(i, t, "en", "src1", len(t or ""), "x", 1, 2.0, True) for i, t in rows]
    return spark.createDataFrame(
        full,
        "doc_id long, text string, lang string, source string, n_chars long, doc string, n int, budget double, kept boolean",
    )


def prose(seed, words):
    rnd = random.Random(seed)
    return " ".join("".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 6))) for _ in range(words))


def edited(text, seed, share):
    rnd = random.Random(seed)
    return " ".join(w if rnd.random() > share else f"x{rnd.randrange(10**6)}" for w in text.split())
