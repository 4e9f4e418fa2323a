"""PPM arrays against the byte-by-byte trie; the base score against counting."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from datescore.llm import lm_score as L
from llm_corpus import empty, frame, rows


@pytest.mark.parametrize("order", [1, 2, 3, 5])
def test_arrays_equal_the_trie(order):
    rng = random.Random(order)
    train = [bytes(rng.choice(b"abcdr ") for _ in range(rng.randint(0, 60))) for _ in range(30)] + ["é🙂x".encode()]
    texts = train[:5] + [b"", b"zebra", "ü€é".encode(), b"abracadabra abc", bytes(range(128))]
    keys, _ = L.grams(train, order)
    model, trie = L.PpmModel(keys, np.ones(len(keys), int), order), L.PpmTrie(order)
    for t in train:
        trie.learn(t)
    assert model.score(texts) == pytest.approx([trie.log10(t) for t in texts], abs=1e-9)


def test_probabilities_add_up_to_one():
    trie = L.PpmTrie(2).learn(b"abracadabra").learn(b"banana")
    for context in (b"ab", b"zz", b"a\xff", b"\xff\xff", b"na"):
        assert sum(trie.probability(context, b) for b in range(256)) == pytest.approx(1, abs=1e-12)


def test_untrained_model_is_uniform():
    model = L.PpmModel(np.zeros(0, np.uint64), np.zeros(0, np.int64))
    assert model.score([b"abc", b""]) == pytest.approx([-4 * math.log10(256), -math.log10(256)])


def test_adaptive_learns_within_the_text(spark):
    text = b"the same words " * 30
    assert L.PpmTrie().log10(text, adaptive=True) > 10 * L.PpmTrie().log10(text[:15]) and len(L.PpmTrie().learn(b"ab").counts) > 3
    got = {r.doc_id: r.score for r in L.score_adaptively(frame(spark, [(1, "Abab"), (2, None)])).collect()}
    assert got[1] == pytest.approx(L.PpmTrie().log10(b"abab", adaptive=True)) and got[2] == pytest.approx(-math.log10(256))


def _brute(data, order):
    def out(i):
        return zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2

    def low(t):
        return re.sub("[A-Z]", lambda m: m.group().lower(), t or "")

    def tokens(t):
        return [w for w in re.split("[\x20\x09-\x0d]+", low(t)) if w] + ["</s>"]

    c = Counter(w for i, t in data if not out(i) for w in tokens(t))
    n, v = sum(c.values()), len(c)
    trie = L.PpmTrie(order)
    for i, t in data:
        if not out(i):
            trie.learn(low(t).encode())
    rows = []
    for i, t in data:
        w = tokens(t)
        base = sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w)
        rows.append((i, out(i), len(w), sum(c[x] > 0 for x in w), n, round(base, 6), round(trie.log10(low(t).encode()), 6)))
    return Counter(rows)


@pytest.mark.parametrize("frequent", [10, 200_000])
def test_documents_equal_brute_force(spark, frequent):
    """Frequent words in the task and rare ones by shuffle give the same sums."""
    data = [(i, t) for i, t in rows() if len(t or "") < 5000]
    got = L.score_documents(frame(spark, data), order=2, frequent=frequent).collect()
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in got) == _brute(data, 2)


@pytest.mark.parametrize("order,max_nodes", [(2, 40), (3, 1000), (5, 4000)])
def test_a_trie_over_the_node_bound_gives_the_same_scores(spark, order, max_nodes):
    """Frequent grams in the task, the others by shuffle: no order is lowered."""
    data = [(i, t) for i, t in rows() if len(t or "") < 2000] + [(n, f"zebra {n} \u20ac new") for n in range(500, 560)]
    got = L.score_documents(frame(spark, data), order=order, max_nodes=max_nodes).collect()
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in got) == _brute(data, order)


def test_the_bound_given_is_the_one_that_holds(spark, monkeypatch):
    """A bound above the default keeps the whole trie in the broadcast, with all its orders."""
    monkeypatch.setattr(L, "MAX_NODES", 10)
    data = [(i, t) for i, t in rows() if len(t or "") < 2000]
    got = L.score_documents(frame(spark, data), order=3, max_nodes=1 << 22).collect()
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in got) == _brute(data, 3)
    counts = L.corpus_counts(frame(spark, data), 3)
    assert L.ppm_model(counts, 3).order == 3


def test_empty_and_untrained_tables(spark):
    assert L.score_documents(empty(spark)).count() == 0
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    r = L.score_documents(frame(spark, [(held, "two words")])).first()
    assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (True, 3, 0, 0) and r.base_score == 0.0
