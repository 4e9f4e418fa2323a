"""The codec against tiktoken, against the merges run one by one, and round trips."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import tiktoken

from datescore.llm import bpe as B
from llm_corpus import empty, frame, rows

ALPHABET = " \t\n\r\x0b\x0c\x1c\x85\xa0 　aAéß漢字🙂'1٣²½.,-_sdmtlrvé​\x00"


@pytest.fixture(scope="module")
def codec():
    return B.codec()


@pytest.fixture(scope="module")
def reference(codec):
    return tiktoken.Encoding("own", pat_str=B.default_pattern(), mergeable_ranks=codec.ranks, special_tokens={})


def test_ids_equal_tiktoken(codec, reference):
    rng = random.Random(2)
    texts = ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 40))) for _ in range(5000)]
    texts += [t or "" for _, t in rows()] + ["", " ", "  ", "a" * 5000, "ab" * 3000, "<|endoftext|>", "é" * 999]
    for t in texts:
        ids = codec.encode(t)
        assert ids.tolist() == reference.encode_ordinary(t), t
        assert codec.decode(ids) == t.encode()


def test_pieces_equal_the_merges():
    """A vocabulary where the longest match is often wrong and passes must be taken back."""
    tokens = ["a", "b", "c", "ab", "bc", "abc", "ca", "bca", "cab", "aa", "aaa", "abab", "bb", "cc", "ccab"]
    rng = random.Random(7)
    for _ in range(40):
        ranks = {c.encode(): i for i, c in enumerate("abc")}
        for t in rng.sample(tokens[3:], 8):
            left = [k for k in range(1, len(t)) if t[:k].encode() in ranks and t[k:].encode() in ranks]
            if left:
                ranks[t.encode()] = len(ranks)
        small = B.BytePairCodec(ranks, r"\S+|\s+")
        for _ in range(200):
            piece = "".join(rng.choice("abc") for _ in range(rng.randint(1, 14))).encode()
            want = small.merge(piece)
            if all(small.merge(small.tokens[i]) == [i] for i in ranks.values()):
                assert small.encode_piece(piece) == want, (ranks, piece)


def test_memo_generations_do_not_change_ids(codec, reference, monkeypatch):
    monkeypatch.setattr(B, "CHUNKS", 3)
    monkeypatch.setattr(B, "PAIRS", 5)
    small = B.BytePairCodec(codec.ranks, B.default_pattern())
    for t in ["the cat sat on the mat, the hat. unbelievableness"] * 2 + ["thndesea erhaea " * 20]:
        assert small.encode(t).tolist() == reference.encode_ordinary(t)


def test_documents(spark, codec, reference):
    data = rows()
    got = B.encode_and_decode(frame(spark)).collect()

    def digests(i, t):
        ids = reference.encode_ordinary(t or "")
        return i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()

    assert Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == Counter(digests(*d) for d in data)
    back = B.decode_documents(B.encode_documents(frame(spark))).collect()
    assert Counter((r.doc_id, bytes(r.data)) for r in back) == Counter((i, (t or "").encode()) for i, t in data)
    assert B.encode_and_decode(empty(spark)).count() == 0
