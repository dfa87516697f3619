"""Encodings against a library, and the defined cases."""

import base64
import os
import random

import pytest

from evidentia.llm import tokens as K

FILE = f"{K.FOLDER}/byte_bpe_50k.tiktoken"
pytestmark = pytest.mark.skipif(not os.path.exists(FILE), reason="no vocabulary files")


def library():
    tiktoken = pytest.importorskip("tiktoken")
    with open(FILE, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=K.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_random_texts_equal_the_library():
    rng, lib, enc = random.Random(3), library(), K.Encoder(FILE)
    pool = ["a", "e", " ", "  ", "\n", "the", "ing", "é", "漢", "字", "1", "23", ".", ",", "'s", "　", "ก", "😀", "<|endoftext|>", "가", "나", "\t", "un", "believ", "able"]
    texts = ["".join(rng.choice(pool) for _ in range(rng.randint(1, 80))) for _ in range(2000)] + ["가나다라" * 800, "a" * 6000, " " * 3000, "ab" * 4000]
    assert enc.encode(texts) == [lib.encode_ordinary(t) for t in texts]


def test_merging_short_and_long_agree():
    v = K.vocabulary(FILE)
    word = "불확실성의시대에대한보고서".encode() * 3
    assert v.merge(word) == v._merge_long(word)


def test_cases(spark):
    df = spark.createDataFrame([(1, None, 7), (2, "", 7), (3, " ", 7), (4, "<|endoftext|>", 7), (5, "ships", 7), (5, "ships", 7)], "doc_id bigint, text string, ids int")
    got = sorted((r.doc_id, r.ids) for r in K.encode(df).collect())
    lib = library()
    assert got == [(1, []), (2, []), (3, lib.encode_ordinary(" ")), (4, lib.encode_ordinary("<|endoftext|>")), (5, lib.encode_ordinary("ships")), (5, lib.encode_ordinary("ships"))]
    assert len(got[3][1]) > 1 and K.encode(df.where("false")).count() == 0
