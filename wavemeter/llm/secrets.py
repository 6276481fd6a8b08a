"""Secret scans: fixed patterns and a randomness test battery, as column expressions only."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wavemeter.llm.expressions import let, text_of

# The patterns of the base kinds, in the order in which ties are listed. Letters of
# the first are spelt in both cases because only these ASCII letters may differ in case.
ASSIGN = (
    "([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"
    "|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    "[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = "AKIA[A-Z0-9]+"
HEX = "[0-9a-f]+"
# A run of token characters with a digit; the look-behind keeps long runs linear.
TOKEN_CHARACTERS = "A-Za-z0-9+/_=-"
# Alphabets by encoding, smallest first.
DIGITS, LOWER = "0123456789", "abcdefghijklmnopqrstuvwxyz"
ENCODINGS = {
    "hex": DIGITS + LOWER[:6],
    "hex_upper": DIGITS + LOWER[:6].upper(),
    "base32": LOWER.upper() + "234567",
    "base36": DIGITS + LOWER,
    "base62": DIGITS + LOWER.upper() + LOWER,
    "base64": DIGITS + LOWER.upper() + LOWER + "+/",
    "base64url": DIGITS + LOWER.upper() + LOWER + "-_",
}
KINDS = ("assign", "access", "hex", "random")


@dataclass(frozen=True)
class Battery:
    """Shortest token, its bands by length, histogram bins, false discoveries allowed, and the
    chance below which a token is never taken for random."""

    shortest: int = 20
    bands: tuple[int, ...] = (20, 24, 32, 40, 48, 64, 96, 128, 256)
    bins: int = 20
    false_share: float = 0.1
    least_chance: float = 0.001


def spans(text: Column, pattern: str, kind: str, passes) -> Column:
    """Leftmost matches that ``passes`` as structs (start, rank of kind, stop, match).

    The pieces between matches give the places, in code points.
    """
    rank = KINDS.index(kind)
    shape = "array<struct<start:int,rank:int,stop:int,match:string>>"

    def placed(found: Column, pieces: Column) -> Column:
        def step(state: Column, match: Column, i: Column) -> Column:
            return let(
                state["at"] + F.length(F.get(pieces, i)),
                lambda start: F.struct(
                    (start + F.length(match)).alias("at"),
                    F.when(
                        passes(match),
                        F.concat(
                            state["out"],
                            F.array(
                                F.struct(
                                    start.alias("start"),
                                    F.lit(rank).alias("rank"),
                                    (start + F.length(match)).alias("stop"),
                                    match.alias("match"),
                                )
                            ),
                        ),
                    )
                    .otherwise(state["out"])
                    .alias("out"),
                ),
            )

        numbered = F.transform(found, lambda match, i: F.struct(match.alias("match"), i.alias("i")))
        return F.aggregate(
            numbered,
            F.struct(F.lit(0).alias("at"), F.array().cast(shape).alias("out")),
            lambda state, m: step(state, m["match"], m["i"]),
            lambda state: state["out"],
        )

    return F.when(
        text.rlike(pattern),
        let(
            F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
            lambda found: let(F.split(text, pattern, -1), lambda pieces: placed(found, pieces)),
        ),
    ).otherwise(F.array().cast(shape))


def base_spans(text: Column) -> Column:
    """Spans of the fixed patterns by start, then kind."""
    return F.sort_array(
        F.concat(
            spans(
                text, ASSIGN, "assign",
                lambda m: F.length(F.regexp_extract(m, ASSIGN, 2)) >= 6,
            ),
            spans(text, ACCESS, "access", lambda m: F.length(m) >= 20),
            # Runs are whole either way, so the length may stand in the pattern.
            spans(text, HEX.replace("+", "{24,}"), "hex", lambda m: F.lit(True)),
        )
    )


def token_spans(text: Column, battery: Battery) -> Column:
    """Runs of token characters that are long enough and hold a digit and a letter."""
    inner = f"[{TOKEN_CHARACTERS}]"
    pattern = f"(?<!{inner}){inner}{{{battery.shortest},}}"
    return spans(text, pattern, "random", lambda m: m.rlike("[0-9]") & m.rlike("[A-Za-z]"))


def _tail(z: Column) -> Column:
    """Chance that a normal variable lies further from 0 than z (error below 1e-6)."""
    x = F.abs(z) / math.sqrt(2.0)
    t = 1.0 / (1.0 + 0.3275911 * x)
    series = t * (
        0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429)))
    )
    return F.least(F.lit(1.0), series * F.exp(-x * x))


def randomness(token: Column) -> Column:
    """Chance that a uniformly random token of the same length and encoding looks this odd.

    Three tests over the places of the characters in the smallest fitting alphabet: chi-squared
    uniformity, runs above and below the middle, and correlation of neighbours. The smallest of the
    three chances is taken and corrected for being the smallest (1 - (1 - p) ^ 3).
    """
    alphabet = None
    for symbols in ENCODINGS.values():
        fits = token.rlike("^[" + symbols.replace("-", "\\-") + "]+$")
        alphabet = F.when(fits, symbols) if alphabet is None else alphabet.when(fits, symbols)
    alphabet = alphabet.otherwise(ENCODINGS["base64"] + "-_=")

    def tests(places: Column, size: Column) -> Column:
        n = F.size(places).cast("double")
        squares = F.aggregate(
            F.sequence(F.lit(0), size - 1),
            F.lit(0.0),
            lambda total, s: total + F.pow(F.size(F.filter(places, lambda p: p == s)).cast("double"), F.lit(2.0)),
        )
        a = size.cast("double")
        freedom = a - 1.0
        ratio = F.pow(F.greatest(squares * a / n - n, F.lit(0.0)) / freedom, F.lit(1.0 / 3.0))
        chi = (ratio - (1.0 - 2.0 / (9.0 * freedom))) / F.sqrt(2.0 / (9.0 * freedom))
        high = F.size(F.filter(places, lambda p: p * 2 >= size)).cast("double")
        low = n - high
        changes = F.aggregate(
            F.sequence(F.lit(1), F.size(places) - 1),
            F.lit(1.0),
            lambda total, i: total
            + F.when((F.get(places, i) * 2 >= size) != (F.get(places, i - 1) * 2 >= size), 1.0).otherwise(0.0),
        )
        mean = 2.0 * high * low / n + 1.0
        spread = (mean - 1.0) * (mean - 2.0) / (n - 1.0)
        runs = F.when(spread > 0, (changes - mean) / F.sqrt(spread)).otherwise(F.lit(9.0))
        middle = (a - 1.0) / 2.0
        variance = (a * a - 1.0) / 12.0
        serial = F.aggregate(
            F.sequence(F.lit(1), F.size(places) - 1),
            F.lit(0.0),
            lambda total, i: total
            + (F.get(places, i).cast("double") - middle) * (F.get(places, i - 1).cast("double") - middle),
        ) / (variance * F.sqrt(n - 1.0))
        least = F.least(_tail(chi), _tail(runs), _tail(serial))
        return 1.0 - F.pow(1.0 - least, F.lit(3.0))

    return let(
        alphabet,
        lambda symbols: let(
            F.transform(F.split(token, ""), lambda c: F.position(c, symbols) - 1),
            lambda places: tests(F.filter(places, lambda p: p >= 0), F.length(symbols)),
        ),
    )


def _band(length: Column, battery: Battery) -> Column:
    band = F.lit(0)
    for i, least in enumerate(battery.bands):
        band = F.when(length >= least, i).otherwise(band)
    return band


def _bin(chance: Column, battery: Battery) -> Column:
    return F.least(F.floor(chance * battery.bins), F.lit(battery.bins - 1)).cast("int")


def cuts(texts: DataFrame, text: str, battery: Battery) -> list[float]:
    """Least chance by length band at which the false discoveries stay below the allowed share.

    Random tokens have uniform chances; those above one half tell how many there are. Whatever a
    bin holds beyond that is false. The table has bands times bins rows at most, for any input, so
    it may come to the driver. A band without tokens accepts nothing.
    """
    counted = (
        texts.select(F.explode(token_spans(text_of(texts[text]), battery)).alias("span"))
        .select(
            _band(F.length("span.match"), battery).alias("band"),
            _bin(randomness(F.col("span.match")), battery).alias("bin"),
        )
        .groupBy("band", "bin")
        .count()
        .collect()
    )
    out = []
    for band in range(len(battery.bands)):
        bins = [0] * battery.bins
        for row in counted:
            if row["band"] == band:
                bins[row["bin"]] = row["count"]
        half = battery.bins // 2
        random_per_bin = min(sum(bins), 2 * sum(bins[half:])) / battery.bins
        out.append(2.0)
        for start in range(battery.bins):
            accepted = sum(bins[start:])
            if accepted and 1 - random_per_bin * (battery.bins - start) / accepted <= battery.false_share:
                out[-1] = max(start / battery.bins, battery.least_chance)
                break
    return out


def secret_spans(docs: DataFrame, text: str = "text", battery: Battery = Battery(), into: str = "secrets") -> DataFrame:
    """Add the spans of every row's whole text as array ``into`` of (start, rank, stop, match).

    ``rank`` is the place in ``KINDS``; spans go by start, then rank; places are code points, the
    stop exclusive. Base spans always stay; the battery adds tokens that overlap none of them. Null
    and empty texts have none, repeated rows the same ones, an empty table none. The cuts are
    learnt from all rows in one job before, and two passes read the input. Tokens without a digit or
    without a letter (A-Z, a-z) are never tested, nor counted for the cuts.
    """
    learnt = cuts(docs, text, battery)

    def accepted(span: Column) -> Column:
        least = F.element_at(
            F.array(*map(F.lit, learnt)), _band(F.length(span["match"]), battery) + 1
        )
        return randomness(span["match"]) >= least

    def added(base: Column, tokens: Column) -> Column:
        apart = F.filter(
            tokens,
            lambda t: ~F.exists(base, lambda b: (b["start"] < t["stop"]) & (t["start"] < b["stop"]))
            & accepted(t),
        )
        return F.sort_array(F.concat(base, apart))

    whole = text_of(docs[text])
    return docs.withColumn(
        into,
        let(
            whole,
            lambda t: let(
                token_spans(t, battery),
                lambda tokens: let(
                    base_spans(t),
                    lambda base: F.when(F.size(tokens) > 0, added(base, tokens)).otherwise(base),
                ),
            ),
        ),
    )


def listed(found: Column) -> Column:
    """kind:start:stop of every span, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(
            found,
            lambda s: F.concat_ws(
                ":", F.get(names, s["rank"]), s["start"].cast("string"), s["stop"].cast("string")
            ),
        ),
        ",",
    )


def redact(docs: DataFrame, text: str = "text", length: str | None = None, mask: str = "[SECRET]",
           battery: Battery = Battery()) -> DataFrame:
    """Replace every span by a mask; overlapping spans become one. Rows without stay unchanged.

    ``length`` names a column of characters to bring up to date, if there is one.
    """
    into = "_llm_secrets"
    found = secret_spans(docs, text, battery, into)

    def cleaned(t: Column, secrets: Column) -> Column:
        state = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
        return F.aggregate(
            secrets,
            state,
            lambda s, span: F.when(
                span["start"] >= s["at"],
                F.struct(
                    F.concat(
                        s["out"], F.substr(t, s["at"] + 1, span["start"] - s["at"]), F.lit(mask)
                    ).alias("out"),
                    span["stop"].alias("at"),
                ),
            ).otherwise(
                F.struct(s["out"].alias("out"), F.greatest(s["at"], span["stop"]).alias("at"))
            ),
            lambda s: F.concat(s["out"], F.substr(t, s["at"] + 1, F.length(t))),
        )

    whole = "_llm_text"
    old = F.col(f"`{text}`")
    found = found.withColumn(whole, F.when(F.size(into) > 0, cleaned(old, F.col(into))).otherwise(old))
    columns = []
    for name in docs.columns:
        column = F.col(f"`{name}`")
        if name == text:
            column = F.col(whole)
        elif name == length:
            column = F.when(F.size(into) > 0, F.length(whole).cast("long")).otherwise(column)
        columns.append(column.alias(name))
    return found.select(*columns)


def op7_secret_scan(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    base = F.filter("secrets", lambda s: s["rank"] < 3)

    def count(rank: int) -> Column:
        return F.size(F.filter("secrets", lambda s: s["rank"] == rank)).cast("long")

    return secret_spans(docs).select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("secrets")).alias("spans"),
        count(3).alias("n_random"),
    )
