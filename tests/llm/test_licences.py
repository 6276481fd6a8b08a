import random

from helpers import LONG, documents, prose
from wavemeter.llm.licence_texts import LICENCES
from wavemeter.llm.licences import Scan, Template, found_in, op9_licence_scan, patience, scan_licences

TEMPLATES = [Template(name, text, Scan()) for name, text in sorted(LICENCES.items())]


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], max(row[j], row[j - 1], last + (x == y))
    return row[-1]


def test_patience_is_a_common_subsequence():
    rnd = random.Random(1)
    for _ in range(300):
        a = [rnd.choice("abcdefghij") for _ in range(rnd.randint(0, 30))]
        b = [rnd.choice("abcdefghij") for _ in range(rnd.randint(0, 30))]
        pairs = patience(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:], strict=False))
        assert len(pairs) <= lcs(a, b)


def test_patience_finds_all_of_unique_words():
    rnd = random.Random(2)
    for _ in range(50):
        a = list(range(60))
        b = [x for x in a if rnd.random() < 0.7] + [1000 + x for x in range(20)]
        assert len(patience(a, b)) == lcs(a, b)


def test_every_licence_is_found_whole():
    for name, text in LICENCES.items():
        body = " ".join(text.split())
        around = f"{prose(1, 40)}. {body} {prose(2, 40)}"
        named = [(n, around[a:b], c) for n, a, b, c in found_in(around, TEMPLATES)]
        hits = [x for x in named if x[0] == name]
        assert len(hits) == 1 and hits[0][2] == 1.0
        assert hits[0][1] == body.rstrip("./") or hits[0][1] in body


def test_edits_and_two_copies():
    words = LICENCES["MIT"].split()
    rnd = random.Random(3)
    changed = " ".join(w if rnd.random() > 0.08 else "other" for w in words)
    text = f"{prose(1, 50)} {changed}\n{prose(2, 300)}\n{' '.join(words).upper()} {' '.join(words)}"
    found = [s for s in found_in(text, TEMPLATES) if s[0] == "MIT"]
    assert len(found) == 3 and found[0][3] >= 0.85 and found[1][3] == found[2][3] == 1.0
    assert all(a[2] <= b[1] for a, b in zip(found, found[1:], strict=False))


def test_prose_and_halves_have_none():
    half = " ".join(LICENCES["MIT"].split()[:80])
    for text in (prose(1, 5000), half, "the software is a license of the public version", "", "License", "Licensed under CC BY-ND 4.0."):
        assert found_in(text, TEMPLATES) == []


def test_frames(spark):
    mit = "Released under the MIT License."
    rows = [(1, None), (2, ""), (3, mit), (3, mit), (4, LONG + "\n" + mit + "\n" + LONG), (None, "x " + mit)]
    out = scan_licences(documents(spark, rows)).collect()
    assert sorted((r["doc_id"] or 0, r["n_licences"]) for r in out) == [(0, 1), (1, 0), (2, 0), (3, 1), (3, 1), (4, 1)]
    for r in out:
        for s in r["licences"]:
            text = dict(rows)[r["doc_id"]]
            assert text[s["start"] : s["stop"]] == mit[:-1] and s["licence"] == "MIT-statement"
    assert scan_licences(documents(spark, [])).count() == 0


def test_driver_table(spark, sf):
    statements = [" ".join(t.split()) for n, t in LICENCES.items() if n.endswith("-statement")]
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in op9_licence_scan(spark, sf).collect():
        assert r["n_licences"] == sum(texts[r["doc_id"]].count(s) for s in statements)
