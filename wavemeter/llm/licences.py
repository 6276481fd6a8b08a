"""Licence scans by patience alignment of texts with licence templates."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wavemeter.llm.expressions import ship_code
from wavemeter.llm.licence_texts import LICENCES

_WORD = re.compile(r"[^\W_]+(?:[.\-][^\W_]+)*")


@dataclass(frozen=True)
class Scan:
    """A licence is found where ``coverage`` of its words align within a window of its length
    times ``stretch`` plus ``slack`` words; statements below ``short`` words must align whole."""

    coverage: float = 0.8
    short: int = 16
    stretch: float = 1.25
    slack: int = 4

    def needed(self, words: int) -> int:
        return words if words < self.short else -int(-words * self.coverage // 1)


def patience(a: Sequence[str], b: Sequence[str]) -> list[tuple[int, int]]:
    """Aligned places of equal words, ascending in both.

    Equal ends align. Between them the words that occur once in either part are anchors; of these
    the longest increasing run stays, and every gap between anchors is aligned the same way.
    """
    out: list[tuple[int, int]] = []
    gaps = [(0, len(a), 0, len(b))]
    while gaps:
        a0, a1, b0, b1 = gaps.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        at = {w: j for j, w in enumerate(b[b0:b1], b0) if in_b[w] == 1}
        anchors = [(i, at[w]) for i, w in enumerate(a[a0:a1], a0) if in_a[w] == 1 and w in at]
        # Patience piles: the top of each pile, and for every card the one on the pile before.
        tops: list[int] = []
        cards: list[int] = []
        before: list[int] = []
        for n, (_, j) in enumerate(anchors):
            pile = bisect_left(tops, j)
            before.append(cards[pile - 1] if pile else -1)
            tops[pile : pile + 1] = [j]
            cards[pile : pile + 1] = [n]
        chain = []
        n = cards[-1] if cards else -1
        while n >= 0:
            chain.append(anchors[n])
            n = before[n]
        chain.reverse()
        out.extend(chain)
        if chain:
            edges = [(a0 - 1, b0 - 1), *chain, (a1, b1)]
            gaps.extend((i + 1, k, j + 1, m) for (i, j), (k, m) in zip(edges, edges[1:], strict=False))
    return sorted(out)


class Template:
    """A licence as words, with the counts that a window is held against."""

    def __init__(self, name: str, text: str, scan: Scan):
        self.name = name
        self.words = _WORD.findall(text.lower())
        self.needed = scan.needed(len(self.words))
        self.window = int(len(self.words) * scan.stretch) + scan.slack
        self.counts = Counter(self.words)
        self.vocabulary = frozenset(self.words)

    def possible(self, words: frozenset | set) -> bool:
        """Whether the words of a text leave it open that enough of the template aligns."""
        shared = self.vocabulary & words
        return sum(self.counts[w] for w in shared) >= self.needed

    def find(self, words: Sequence[str]) -> Iterator[tuple[int, int, int]]:
        """Spans (first word, word after, words aligned), leftmost first and apart.

        A window slides over the text; where it holds enough words of the template, counted as
        often as the template has them, it is aligned. A span ends the search in its words alone.
        """
        held: Counter = Counter()
        enough = start = 0
        for stop, word in enumerate(words, 1):
            if stop <= start:  # already in a span
                continue
            if word in self.vocabulary:
                held[word] += 1
                enough += held[word] <= self.counts[word]
            while stop - start > self.window or (start < stop and words[start] not in self.vocabulary):
                gone = words[start]
                if gone in self.vocabulary:
                    enough -= held[gone] <= self.counts[gone]
                    held[gone] -= 1
                start += 1
            last = stop == len(words)
            if enough < self.needed or not (last or stop - start == self.window):
                continue
            aligned = patience(words[start:stop], self.words)
            if len(aligned) < self.needed:
                continue
            # The window may cut the licence off: align again from where it should begin.
            first = max(start, start + aligned[0][0] - aligned[0][1])
            whole = patience(words[first : first + self.window], self.words)
            if len(whole) >= len(aligned):
                start, aligned = first, whole
            end = start + aligned[-1][0] + 1
            yield start + aligned[0][0], end, len(aligned)
            # What lies behind the span may begin the next one.
            start, held = end, Counter(w for w in words[end:stop] if w in self.vocabulary)
            enough = sum(min(n, self.counts[w]) for w, n in held.items())


def found_in(text: str, templates: Sequence[Template]) -> list[tuple[str, int, int, float]]:
    """(licence, first code point, code point after, coverage) by place, then name."""
    lowered = text.lower()
    words = _WORD.findall(lowered)
    kinds = set(words)
    possible = [t for t in templates if t.possible(kinds)]
    if not possible:
        return []
    places = [m.span() for m in _WORD.finditer(lowered)]
    out = [
        (t.name, places[first][0], places[stop - 1][1], aligned / len(t.words))
        for t in possible
        for first, stop, aligned in t.find(words)
    ]
    return sorted(out, key=lambda s: (s[1], s[2], s[0]))


def scan_licences(
    docs: DataFrame,
    licences: Mapping[str, str] = LICENCES,
    scan: Scan = Scan(),
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per row: key, ``n_licences``, ``licences`` (name, start, stop, coverage by place).

    Whole texts are searched. Null and empty texts have no licence; repeated rows give the same;
    an empty table gives no rows; other columns are ignored. Start and stop are code points (of the
    lower-cased text, should that be longer than the text itself). Rows are independent, so no
    shuffle is needed; the templates are a parameter and go along with the tasks.
    """
    ship_code(docs.sparkSession)

    def run(batches):
        templates = [Template(name, body, scan) for name, body in sorted(licences.items())]
        for batch in batches:
            found = [found_in(t.as_py() or "", templates) for t in batch["_text"]]
            rows = [
                [{"licence": n, "start": a, "stop": b, "coverage": c} for n, a, b, c in spans] for spans in found
            ]
            kind = pa.list_(pa.struct([("licence", pa.string()), ("start", pa.int64()), ("stop", pa.int64()), ("coverage", pa.float64())]))
            yield pa.RecordBatch.from_arrays(
                [batch["_key"], pa.array([len(s) for s in found], pa.int64()), pa.array(rows, kind)],
                names=[key, "n_licences", "licences"],
            )

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(docs[key].alias("_key"), docs[text].cast("string").alias("_text")).mapInArrow(
        run,
        f"`{key}` {kind}, n_licences long, licences array<struct<licence:string,start:long,stop:long,coverage:double>>",
    )


def op9_licence_scan(spark, sf_dir: str) -> DataFrame:
    found = scan_licences(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    listed = F.transform(
        "licences",
        lambda s: F.concat_ws(":", s["licence"], s["start"].cast("string"), s["stop"].cast("string")),
    )
    return found.select(
        "doc_id",
        "n_licences",
        F.array_join(listed, ",").alias("licences"),
        F.coalesce(F.array_max(F.transform("licences", lambda s: s["coverage"])), F.lit(0.0)).alias("best_coverage"),
    )
