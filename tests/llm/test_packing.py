"""Packing: the plan uses every piece once, ids equal the tokenizer's, little padding."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from datescore.llm import packing as K
from llm_corpus import empty, frame, rows


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def _check_plan(histogram, window):
    patterns = K.plan(histogram, window)
    used = Counter()
    for lengths, times in patterns:
        assert times > 0 and sum(lengths) <= window
        for v in lengths:
            used[v] += times
    assert used == Counter({v: int(n) for v, n in enumerate(histogram) if n})
    return sum(times for _, times in patterns)


def test_plans_use_every_piece_once():
    rng = np.random.default_rng(4)
    for window in (2, 3, 8, 64):
        for _ in range(40):
            h = rng.integers(0, rng.choice([2, 20, 1000]), window + 1)
            h[0] = 0
            _check_plan(h, window)


def test_plan_is_tight_and_does_not_grow_with_the_input():
    rng = np.random.default_rng(5)
    lengths = np.minimum(rng.lognormal(5.5, 0.8, 200_000).astype(int) + 1, 1024)
    h = np.bincount(lengths, minlength=1025)
    sequences = _check_plan(h, 1024)
    assert lengths.sum() / (sequences * 1024) > 0.995
    assert len(K.intervals(K.plan(h * 1000, 1024))) < 3 * len(K.intervals(K.plan(h, 1024)))


def test_least_squares_matches_a_solvable_histogram():
    """Exactly packable: the solver's residual vanishes and no sequence is padded."""
    window = 16
    h = np.zeros(window + 1, dtype=int)
    for lengths, times in (((3, 13), 50), ((5, 5, 6), 40), ((8, 8), 7), ((1, 2, 13), 9)):
        for v in lengths:
            h[v] += times
    assert _check_plan(h, window) == 50 + 40 + 7 + 9


def test_documents(spark, tokenizer):
    data = rows()
    got = K.pack_documents(frame(spark)).collect()

    def pieces(t):
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [0]
        return [(s, len(p), zlib.crc32(np.array(p, "<u4").tobytes()), len(ids)) for s in range(0, len(ids), 1024) for p in [ids[s : s + 1024]]]

    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got) == Counter((i, *p) for i, t in data for p in pieces(t))
    by = defaultdict(list)
    for r in got:
        by[r.sequence_id].append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    assert set(by) == set(range(len(by)))
    assert sum(r.length for r in got) / (1024 * len(by)) > 0.9


def test_special_token_text_is_the_tokenizers_own(tokenizer):
    with open(public_tokenizers.path("byte_bpe_50k.json"), "rb") as f:
        ids = K.TokenIds(f.read(), public_tokenizers.PATTERN)
    assert ids.fast is not None
    rng = random.Random(6)
    for t in ["a <|endoftext|> b", "<|endoftext|>", "plain  text\n\n é🙂", *("".join(rng.choice(" \nabé漢1'.") for _ in range(30)) for _ in range(300))]:
        assert ids(t).tolist() == tokenizer.encode(t, add_special_tokens=False).ids


def test_sequences_hold_the_ids(spark, tokenizer):
    data = [(i, f"document number {i} " * (i % 7)) for i in range(60)]
    got = K.token_sequences(frame(spark, data), window=64).collect()
    stream = Counter()
    for r in got:
        ids = np.frombuffer(bytes(r.ids), "<u4").tolist()
        assert len(ids) == r.length <= 64
        stream.update(ids)
    assert stream == Counter(x for _, t in data for x in tokenizer.encode(t, add_special_tokens=False).ids + [0])


def test_repeated_rows_and_empty_table(spark):
    got = K.pack_documents(frame(spark, [(7, "same words")] * 5000 + [(8, None)] * 10))
    assert got.count() == 5010 and got.select("sequence_id", "offset").distinct().count() == 5010
    assert K.pack_documents(empty(spark)).count() == 0
