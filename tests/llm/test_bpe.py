import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken

from tallyline.llm import bpe

PATH = P.path("byte_bpe_multi_50k.tiktoken")
RANKS = bpe.load_ranks(PATH)
LIBRARY = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def expected(text):
    return np.array(LIBRARY.encode_ordinary(text or ""), "<u4").tobytes()


def texts():
    rng = random.Random(5)
    alphabet = "aaabbéß ñ\n\t 0123'sltre.,!?漢字😀 \x1c#"
    made = ["".join(rng.choices(alphabet, k=rng.randrange(120))) for _ in range(300)]
    return [None, "", " ", "a" * 5000, "ab" * 3000, "naïve café " * 2000, "<|endoftext|>", *made, made[0]]


def test_encode_matches_the_library_and_decodes(spark):
    rows = list(enumerate(texts()))
    docs = spark.createDataFrame([(i, t, "x", t) for i, t in rows], "doc_id long, text string, ids string, n_tokens string")
    got = {r.doc_id: r for r in bpe.encode(docs, PATH, P.PATTERN, decoded=True).collect()}
    assert len(got) == len(rows)
    for i, t in rows:
        assert bytes(got[i].ids) == expected(t), repr(t)[:60]
        assert bytes(got[i].decoded) == (t or "").encode()
        assert got[i].n_tokens == len(got[i].ids) // 4
    again = bpe.decode(bpe.encode(docs, PATH, P.PATTERN), PATH)
    assert {r.doc_id: bytes(r.decoded) for r in again.collect()} == {i: (t or "").encode() for i, t in rows}


def test_empty_table(spark):
    assert bpe.encode(spark.createDataFrame([], "doc_id long, text string"), PATH, P.PATTERN).count() == 0


def test_lower_rank_that_arises_goes_first():
    ranks = {bytes([b]): b for b in range(256)} | {b"bc": 300, b"ab": 301, b"abd": 256, b"da": 257, b"abda": 400}
    slow = tiktoken.Encoding("own", pat_str=r"[a-z]+", mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(1)
    words = ["".join(rng.choices("abcd", k=rng.randrange(1, 14))) for _ in range(3000)]
    got = bpe.MergeReplay(ranks).encode([w.encode() for w in words])
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [slow.encode_ordinary(w) for w in words]


@pytest.mark.parametrize("limit", [3, 10_000])
def test_bounded_table(monkeypatch, limit):
    monkeypatch.setattr(bpe, "TABLE_WORDS", limit)
    encoder = bpe.Encoder(RANKS, P.PATTERN)
    for _ in range(2):
        for t in texts():
            assert encoder.encode([t or ""]) == [expected(t)]


def test_query(spark):
    from tallyline.llm.queries import QUERIES

    rows = QUERIES["op1_byte_bpe"](spark, "/root/testdata/sf0.001").collect()
    source = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    assert len(rows) == len(source)
    for r in rows:
        ids = expected(source[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids) // 4, hashlib.sha256(ids).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256((source[r.doc_id] or "").encode()).hexdigest()
