"""Cross-tokenizer alignment: plain loops over token pairs, bitmaps and planes, chunks."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from conftest import SF001
from datescore.llm import token_links as L
from datescore.llm.packing import _byte_alphabet
from llm_corpus import empty, frame, rows

ODD = [(900, "<|endoftext|> a <0x41> ▁ b"), (901, "x <unk> <s> y <|endoftext|>"), (902, "tab\there  two  spaces"), (903, " lead"),
       (904, "nbsp  ﬁ ligature"), (905, "plain <0x41> text"), (906, "<|endoftext|>"), (907, "é combined"), (908, "🙂🙂 x🙂")]


def _tokens():
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    names, byte = {i: t for t, i in a.get_vocab().items()}, _byte_alphabet()
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))

    def encode(text):
        ia, ib = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        pieces = [b.id_to_piece(i) for i in ib]
        return (ia, [bytes(byte[c] for c in names[i]) for i in ia], ib,
                [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(ib, pieces)])

    return encode


def _ranges(tokens):
    at, out = 0, []
    for t in tokens:
        out.append((at, at + len(t)))
        at += len(t)
    return out


def brute(data):
    encode, docs, count = _tokens(), [], Counter()
    for i, text in data:
        ia, ta, ib, tb = encode(text) if text else ([], [], [], [])
        whole = (" " + text).encode() if text else None
        if not text or b"".join(ta) != whole or b"".join(tb) != whole:
            docs.append((i, None))
            continue
        ra, rb = _ranges(ta), _ranges(tb)
        links, first = [], 0
        for x, (lo, hi) in zip(ia, ra):
            while rb[first][1] <= lo:
                first += 1
            for y, (start, _) in zip(ib[first:], rb[first:]):
                if start >= hi:
                    break
                links.append((x, y))
        cuts = sorted({e for _, e in ra} & {e for _, e in rb})
        groups = [",".join(str(x) for x, (lo, hi) in zip(ia, ra) if s <= lo and hi <= e) + "|"
                  + ",".join(str(y) for y, (lo, hi) in zip(ib, rb) if s <= lo and hi <= e) for s, e in zip([0, *cuts], cuts)] if len(ia) < 3000 else None
        docs.append((i, (len(ia), len(ib), len(cuts), links, groups)))
        count.update(set(links))
    top = defaultdict(int)
    for (x, _), n in count.items():
        top[x] = max(top[x], n)
    out = Counter()
    for i, d in docs:
        if d is None:
            out[(i, 0, 0, 0, 0, 0, 0, "")] += 1
        else:
            na, nb, n, links, groups = d
            digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups is not None else "long"
            out[(i, na, nb, n, len(links), sum(count[p] == top[p[0]] for p in links), sum(count[p] for p in links), digest)] += 1
    return out


def _got(df):
    return Counter((*r[:7], "long" if r[1] >= 3000 else r[7]) for r in map(tuple, df.collect()))


@pytest.mark.parametrize("parts", [1, 4])
def test_equals_plain_loops(spark, parts):
    data = rows() + ODD
    assert _got(L.link_scores(frame(spark, data, parts))) == brute(data)


def test_small_chunks_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(L, "CHUNK_TEXT", 3000)
    monkeypatch.setattr(L, "SLICE", 1000)
    data = rows() + ODD
    assert _got(L.link_scores(frame(spark, data))) == brute(data)


def test_table(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    assert _got(L.link_scores(docs)) == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_empty(spark):
    assert L.link_scores(empty(spark)).collect() == []
    assert [tuple(r) for r in L.link_scores(frame(spark, [(1, None)])).collect()] == [(1, 0, 0, 0, 0, 0, 0, "")]


@pytest.mark.parametrize("rows_in", [1, 9, 200, 65536])
def test_bitmaps_and_planes_round_trip(rows_in):
    rng = np.random.default_rng(rows_in)
    numbers, counts, first, at = [], [], [], 0
    for _ in range(60):
        n = int(rng.integers(1, min(rows_in, 300) + 1)) if rng.random() < 0.8 else min(rows_in, 20_000)
        first.append(at)
        numbers.append(np.sort(rng.choice(rows_in, n, replace=False)))
        counts.append(rng.integers(1, 2 if rng.random() < 0.5 else int(rng.integers(2, 5000)), n))
        at += n
    number, count, first = np.concatenate(numbers), np.concatenate(counts), np.array(first)
    docs, dense = L.pack(number, first, rows_in)
    posting, back, times = L.unpack(docs, dense.to_numpy(zero_copy_only=False), L.planes(count, first))
    assert posting.tolist() == np.repeat(np.arange(len(first)), np.diff(np.append(first, at))).tolist()
    assert back.tolist() == number.tolist() and times.tolist() == count.tolist()
    # A container is never longer than plain bits.
    assert max(len(x.as_py()) for x in docs) <= -(-rows_in // 8)


def test_counts_by_popcount(spark):
    docs = frame(spark, [(1, "red fish"), (2, "red fish red fish"), (3, "red"), (3, "red"), (4, None)], 2)
    counts = {(r.a, r.b): (r.documents, r.best) for r in L.pair_counts(L.written(L.postings(docs), "t")).collect()}
    encode = _tokens()
    a, _, b, _ = encode("red fish")
    assert len(a) == len(b) == 2
    assert counts == {(a[0], b[0]): (4, True), (a[1], b[1]): (2, True)}
