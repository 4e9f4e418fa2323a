"""Benchmark decontamination: the automaton against all windows, cuts, several automata."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import pytest

from conftest import plan_text
from datescore.llm import decontaminate as D
from llm_corpus import empty, frame, rows

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def items():
    base = next(t for i, t in rows() if i == 100)
    w = base.split(" ")
    out = [(1, " ".join(w[5:40])), (2, " ".join(w[30:42])), (3, " ".join(w[5:40]).upper()), (4, "one two"), (5, "One"), (6, None), (7, " .,"),
           (8, "word " * 10), (9, "word word"), (10, "left text here"), (11, "nowhere at all"), (11, "right text there"), (None, "no id"),
           (10, "left text here"), (12, " ".join(w[60:69]) + " other words follow"), (20, "one two"), (21, "two")]
    rng = random.Random(9)
    return out + [(30 + k, " ".join(rng.choice("abc") for _ in range(rng.randint(3, 30)))) for k in range(40)]


def documents():
    rng = random.Random(10)
    return rows() + [(700 + k, " ".join(rng.choice("abcd") for _ in range(rng.randint(0, 60)))) for k in range(40)]


def brute(docs, tests, window=10):
    out = []
    for i, text in docs:
        w, hit, found = words(text), set(), set()
        for item, t in tests:
            v = words(t)
            n = min(window, len(v))
            for k in range(len(v) - n + 1 if n else 0):
                for j in range(len(w) - n + 1):
                    if w[j : j + n] == v[k : k + n]:
                        hit |= set(range(j, j + n))
                        found.add("" if item is None else str(item))
        out.append((i, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return Counter(out)


def benchmark(spark, data):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in data], "item_id long, text string, spans string, n_words int").repartition(2)


SMALL = [d for d in documents() if len(d[1] or "") < 2000]


@pytest.mark.parametrize("block_words", [100_000, 60])
def test_equals_all_windows(spark, block_words):
    """With 60 words an automaton: several passes, the long items in overlapping parts."""
    got = D.overlap_report(frame(spark, SMALL), benchmark(spark, items()), block_words=block_words)
    assert Counter(tuple(r) for r in got.collect()) == brute(SMALL, items())


def test_long_texts_give_the_same_with_one_and_several_automata(spark):
    docs, tests = frame(spark, documents()), benchmark(spark, items())
    whole = Counter(tuple(r) for r in D.overlap_report(docs, tests).collect())
    assert whole == Counter(tuple(r) for r in D.overlap_report(docs, tests, block_words=40).collect())
    assert sum(whole.values()) == len(documents())


@pytest.mark.parametrize("seed", range(30))
def test_automaton_against_all_windows(seed):
    rng = random.Random(seed)
    window = rng.randint(2, 5)
    tests = [(k, " ".join(rng.choice("ab") for _ in range(rng.randint(0, 9)))) for k in range(rng.randint(1, 12))]
    docs = [(k, " ".join(rng.choice("abz") for _ in range(rng.randint(0, 40)))) for k in range(30)]
    machine = D.Automaton([(tuple(x.encode() for x in words(t)), len(words(t)) < window, [str(i)]) for i, t in tests if words(t)], window)
    got = []
    for i, text in docs:
        w = D.normalised(text).split()
        spans, found = machine.spans(w)
        assert all(b < c for (_, b), (c, _) in zip(spans, spans[1:]))
        n = sum(b - a for a, b in spans)
        got.append((i, len(w), n, len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), n > 0))
    assert Counter(got) == brute(docs, tests, window)


def test_documents_are_not_shuffled(spark):
    plan = plan_text(D.overlap_report(frame(spark, SMALL).coalesce(1), benchmark(spark, items())))
    assert plan.count("Exchange") <= 1  # that of the test's own repartition


def test_no_items_no_documents(spark):
    none = benchmark(spark, [(1, None), (2, "")])
    assert not D.overlap_report(frame(spark), none).where("contaminated or n_items > 0").count()
    assert D.overlap_report(empty(spark), benchmark(spark, items())).collect() == []
    assert D.overlap_report(empty(spark), benchmark(spark, items()), block_words=40).collect() == []


def test_cut_leaves_the_rest_as_it_is():
    assert D.cut("Été: a b, c! d e", [1, 3]) == "Été: , c! d e"
    assert D.cut("a b c", [0, 3]) == "" and D.cut("a b c", [0, 1, 2, 3]) == " b "
    assert D.cut("x", []) == "x"


def test_clean_documents_cut_spans_and_drop_covered_ones(spark):
    source = [(1, "keep this and one two and more words after it"), (2, "one two"), (3, None), (4, "nothing here at all"), (None, "a one")]
    docs, tests = frame(spark, source), benchmark(spark, [(1, "one two"), (2, "one")])
    clean = D.clean_documents(docs, tests, max_coverage=0.5)
    assert clean.columns == docs.columns and clean.schema == docs.schema
    got = {r.doc_id: r.text for r in clean.collect()}
    assert got == {1: "keep this and  and more words after it", 3: None, 4: "nothing here at all", None: "a "}
    for words_in in (100_000, 2):
        again = D.clean_documents(docs, tests, max_coverage=1.0, block_words=words_in)
        assert again.count() == 5 and not D.overlap_report(again, tests).where("contaminated").count()
