"""Components of the n-gram Jaccard join against all pairs."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest

from datescore.llm import ngram_join as J
from llm_corpus import empty, frame, rows


def shingles(text, n):
    w = [x for x in re.split("[\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or "")) if x]
    if not w:
        return frozenset()
    return frozenset(tuple(w[k : k + n]) for k in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)])


def brute(data, n, num, den):
    """(doc_id, size, component) of all rows, every pair compared."""
    sets = [shingles(t, n) for _, t in data]
    root = list(range(len(data)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(data)):
        for b in range(a):
            k = len(sets[a] & sets[b])
            if k and den * k >= num * (len(sets[a]) + len(sets[b]) - k):
                root[find(a)] = find(b)
    least = {}
    for a, (i, _) in enumerate(data):
        if i is not None:
            r = find(a)
            least[r] = min(i, least.get(r, i))
    return Counter((i, len(s), (least.get(find(a)) if s else i)) for a, ((i, _), s) in enumerate(zip(data, sets)))


def near_copies(count, words, edits, seed):
    """A group of near copies in a corpus of unrelated texts that share a passage."""
    rng = random.Random(seed)
    passage = [f"p{k}" for k in range(30)]
    base = [f"b{rng.randint(0, 10**6)}" for _ in range(words)]
    data = []
    for i in range(count):
        w = base.copy()
        for _ in range(rng.choice(edits)):
            w[rng.randrange(words)] = f"e{rng.randint(0, 10**6)}"
        data.append((1000 - i, " ".join(w)))
    for i in range(count):
        data.append((2000 + i, " ".join([f"u{rng.randint(0, 10**6)}" for _ in range(rng.randint(1, 40))] + passage)))
    rng.shuffle(data)
    return data


@pytest.mark.parametrize("n,num,den", [(3, 90, 100), (5, 8, 10), (1, 1, 2)])
def test_components_equal_all_pairs(spark, n, num, den):
    got = J.near_classes(frame(spark), n, num, den).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute(rows(), n, num, den)


@pytest.mark.parametrize("edits,seed", [([0, 1, 2, 3, 4], 1), ([1, 2], 2), ([2], 3), ([3, 5, 8], 4)])
def test_groups_of_near_copies(spark, edits, seed):
    """Also without the text that all copies come from, where hubs link few."""
    data = near_copies(70, 100, edits, seed)
    got = J.near_classes(frame(spark, data), 3, 90, 100).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute(data, 3, 90, 100)


def test_similarity_at_the_threshold():
    """Exactly 90 in 100 links, one less does not; filters agree with the plain count."""
    rng = np.random.default_rng(2)
    for _ in range(400):
        common, a, b = rng.integers(0, 40), rng.integers(0, 8), rng.integers(0, 8)
        pool = rng.permutation(1000).astype(np.uint64)
        x = np.sort(np.concatenate([pool[:common], pool[100 : 100 + a]]))
        y = np.sort(np.concatenate([pool[:common], pool[200 : 200 + b]]))
        if len(x) and len(y):
            assert J.similar(x, y, 90, 100) == (100 * common >= 90 * (common + a + b))
            bins = [np.frombuffer(J.bins_of(s << np.uint64(54)), np.uint8)[None] for s in (x, y)]
            assert J.differ_at_least(*bins)[0] <= a + b
    assert J.similar(np.arange(9, dtype=np.uint64), np.arange(10, dtype=np.uint64), 90, 100)


def test_shingles_count_like_tuples():
    texts = [t or "" for _, t in rows()]
    for n in (1, 3, 5):
        sets = J.shingle_sets([t.encode() for t in texts], n)
        assert [len(s) for s in sets] == [len(shingles(t, n)) for t in texts]
        alone = [J.shingle_sets([t.encode()], n)[0] for t in texts]
        assert all((a == b).all() for a, b in zip(sets, alone))


def test_long_chain_is_one_component(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1001), (1001, 1002)], "a long, b long")
    got = dict(J.components(links).collect())
    assert got == {i: 0 for i in range(301)} | {1000: 1000, 1001: 1000, 1002: 1000}


def test_keep_one_returns_whole_rows(spark):
    data = rows()
    docs = frame(spark)
    kept = J.keep_one(docs, 3, 90, 100)
    assert kept.columns == docs.columns
    with_words = Counter()
    want = brute(data, 3, 90, 100)
    ids = Counter(r.doc_id for r in kept.collect())
    empties = Counter(i for i, t in data if not shingles(t, 3))
    for (i, size, component), _ in want.items():
        if size and i == component:
            with_words[i] = 1
    for i, c in empties.items():
        with_words[i] += c
    assert {i: c for i, c in ids.items() if i is not None} == {i: c for i, c in with_words.items() if i is not None}


def test_empty_table(spark):
    assert J.near_classes(empty(spark)).count() == 0 and J.keep_one(empty(spark)).count() == 0
