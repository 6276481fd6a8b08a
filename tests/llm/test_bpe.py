import base64
import random

import public_tokenizers
import pytest
import tiktoken

from helpers import documents, prose
from wavemeter.llm.bpe import Coder, decode, encode, op5_byte_bpe, read_ranks

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def nasty(n):
    rnd = random.Random(n)
    letters = "abcdeE'stredllv \n\t\r\x0b\x1c\x85\xa0 éßñ中文字😀́١٢1234567890.,!<|>_-​"
    return ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 90))) for _ in range(n)]


def test_words_as_the_library(library):
    coder = Coder.of(read_ranks(PATH), PATTERN)
    texts = nasty(800) + ["", "a" * 3000, "ab" * 500, " " * 900, "\n" * 300, "x" * 64, "y" * 65, "中" * 200, "<|endoftext|>"]
    texts += ["".join(random.Random(1).choice("etaoinshr") for _ in range(300))]
    ids = coder.encode(texts)
    assert ids.to_pylist() == [library.encode_ordinary(t) for t in texts]
    assert coder.decode(ids).to_pylist() == [t.encode() for t in texts]


def test_rare_words_are_forgotten(library):
    coder = Coder(read_ranks(PATH), PATTERN, most=6)
    for text in nasty(20):
        assert coder.encode([text + " frequentword frequentword"]).to_pylist() == [
            library.encode_ordinary(text + " frequentword frequentword")
        ]
    coder._forget()
    assert " frequentword" in coder.known and len(coder.known) <= 3


def test_frames(spark, library):
    long = prose(1, 150_000)
    texts = [None, "", "hello world", "hello world", long, *nasty(30)]
    docs = documents(spark, list(enumerate(texts)))
    coded = encode(docs, PATH, PATTERN)
    assert set(coded.columns) == {*docs.columns, "ids"} - {"text"}
    rows = {r["doc_id"]: r for r in coded.collect()}
    back = {r["doc_id"]: r["decoded"] for r in decode(coded, PATH, PATTERN).collect()}
    for i, text in enumerate(texts):
        assert rows[i]["ids"] == library.encode_ordinary(text or "") and rows[i]["doc"] == "x"
        assert bytes(back[i]) == (text or "").encode()
    both = encode(docs, PATH, PATTERN, back="kept").collect()
    assert {r["doc_id"]: (r["ids"], bytes(r["kept"])) for r in both} == {
        i: (rows[i]["ids"], (t or "").encode()) for i, t in enumerate(texts)
    }
    assert encode(docs.limit(0), PATH, PATTERN).count() == 0
    assert decode(coded.limit(0), PATH, PATTERN).count() == 0


def test_driver_table(spark, sf, library):
    import hashlib

    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in op5_byte_bpe(spark, sf).collect():
        ids = library.encode_ordinary(texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()
