"""Fingerprints: order independence, increments, likeness; edited texts against brute force."""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pytest

from datescore.llm import fingerprints as P
from conftest import SF01
from llm_corpus import empty, frame, rows


def _text(text):
    return P.as_text(*P.fingerprints([text]))[0]


def test_equal_for_any_order_and_only_for_equal_multisets():
    a, b, c = "One sentence here. Two more words!", "Line two", "Line three?"
    assert _text("\n".join([a, b, c])) == _text("\n".join([c, a, b])) == _text(f"{c}\n {b} \n\n{a}\n")
    assert _text("\n".join([a, b, b])) != _text("\n".join([a, b])) != _text(b)
    assert set(_text("")) == {"0"} and _text("") == _text(" \n ") and len(_text("x")) == 2 * (8 * P.WIDE + 4 * P.LANES)


def test_copies_of_units_that_are_there_are_inserted_after_them():
    a, b = "x y z\nx y z\np q r", "x y z\nnew words here"
    whole = P.fingerprints([a + "\n" + b])
    added = P.fingerprints([b], [Counter(P.units(a))])
    assert P.as_text(*P.combine(P.fingerprints([a]), added)) == P.as_text(*whole)
    assert P.as_text(*P.combine(whole, added, -1)) == P.as_text(*P.fingerprints([a]))


def test_units_are_found_again_after_changes():
    words = [f"w{k * 7919 % 1000}" for k in range(400)]
    assert all(len(u.split()) <= P.MOST for u in P.units(" ".join(words))) and P.units(" \n\t") == []
    assert " ".join(P.units("a  b\tc\nd")) == "a b c d"
    changed = Counter(P.units(" ".join(["other", "start", "x", *words])))
    assert sum((Counter(P.units(" ".join(words))) & changed).values()) > 0.9 * len(P.units(" ".join(words)))


def test_long_texts_are_summed_in_pieces():
    text = "\n".join(f"line number {k % 9000} here" for k in range(30_000))
    words, lanes = P.fingerprints(["", "a b", text, "", "c d e f"])
    for k, t in enumerate(["", "a b", text, "", "c d e f"]):
        one = P.fingerprints([t])
        assert (words[k] == one[0][0]).all() and (lanes[k] == one[1][0]).all()
    total, seen = np.zeros(P.LANES, dtype=np.int64), Counter()
    for u in P.units(text):
        total += P._signs(P._digests([u]), np.array([seen[u]]))[0].astype(np.int64) * 2 - 1
        seen[u] += 1
    assert (lanes[2] == total).all()


def test_likeness_on_the_table(spark):
    """Half of a text is unchanged, so it is like its edited text; it is unlike the next document, unless they share much."""
    data = sorted(((r.doc_id, r.text or "") for r in spark.read.parquet(f"{SF01}/documents.parquet").collect()), reverse=True)
    texts = [t for _, t in data]
    edited = [t[: len(t) - len(t) // 2] + texts[(k + 1) % len(texts)][: len(t) // 2] for k, t in enumerate(texts)]
    prints, changed = P.fingerprints(texts), P.fingerprints(edited)
    after = tuple(np.roll(x, -1, axis=0) for x in prints)
    long = np.array([len(t) >= 100 for t in texts])
    near_edited, near_next = P.likeness(prints, changed)[long], P.likeness(prints, after)[long]
    assert (near_edited < 0.2).mean() < 0.002 and np.median(near_edited) > 0.4
    assert (near_next > 0.2).mean() < 0.002


def test_insertion_and_deletion_are_additions():
    whole, part, rest = (P.fingerprints([t]) for t in ("a b c\nd e f\ng", "d e f", "a b c\ng"))
    assert P.as_text(*P.combine(rest, part)) == P.as_text(*whole)
    assert P.as_text(*P.combine(whole, part, -1)) == P.as_text(*rest)
    assert P.as_text(*P.from_text(_text("a b c\nd e f\ng"))) == P.as_text(*whole)


def test_likeness_follows_the_shared_units():
    lines = [f"line number {k}" for k in range(400)]
    base = P.fingerprints(["\n".join(lines)])
    for share in (0.0, 0.25, 0.5, 0.75):
        keep = int(400 * share)
        other = P.fingerprints(["\n".join(lines[:keep] + [f"else {k}" for k in range(400 - keep)])])
        assert P.likeness(base, other)[0] == pytest.approx(share, abs=0.25)
    assert P.likeness(base, base)[0] == 1.0 and P.likeness(base, P.fingerprints([""]))[0] == 0.0
    assert P.likeness(P.fingerprints([""]), P.fingerprints([""]))[0] == 1.0


def _brute(data):
    order = sorted(data, key=lambda d: (d[0] is None, -(d[0] or 0), d[1] or ""))
    out = []
    for k, (i, t) in enumerate(order):
        t, following = t or "", order[(k + 1) % len(order)][1] or ""
        half = len(t) // 2
        edited = t[: len(t) - half] + following[:half]
        prints = [P.fingerprints([x]) for x in (t, edited, following)]
        out.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), P.as_text(*prints[0])[0], P.as_text(*prints[1])[0],
                    round(float(P.likeness(prints[0], prints[1])[0]), 9), round(float(P.likeness(prints[0], prints[2])[0]), 9)))
    return Counter(out)


def _rows(df):
    return Counter((r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, round(r.near_edited, 9), round(r.near_next, 9))
                   for r in df.collect())


@pytest.mark.parametrize("parts", [1, 5])
def test_edited_texts_equal_brute_force(spark, parts):
    assert _rows(P.compare_edits(spark, frame(spark, parts=parts))) == _brute(rows())


def test_small_tables(spark):
    assert P.compare_edits(spark, empty(spark)).count() == 0
    for data in ([(5, "only one. here")], [(5, "a b"), (5, "c d")], [(None, "x y z"), (None, None)]):
        assert _rows(P.compare_edits(spark, frame(spark, data))) == _brute(data)


def test_fingerprints_of_documents(spark):
    got = Counter((r.doc_id, r.fingerprint) for r in P.fingerprint_documents(frame(spark)).collect())
    assert got == Counter((i, _text(t or "")) for i, t in rows())
    assert np.all(P.fingerprints(["a", "a"])[0][0] == P.fingerprints(["a"])[0][0])
