"""Base forms against the contract's plain patterns; bootstrapping on planted contexts."""

from __future__ import annotations

import hashlib
import random
import re

from datescore.llm import pii as P
from llm_corpus import empty, frame

# The contract's patterns, as they stand.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def brute(text):
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    for m in CARD.finditer(text):
        d = re.sub("[ -]", "", m.group())
        total = sum(sum(divmod(int(c) * 2, 10)) if k % 2 else int(c) for k, c in enumerate(reversed(d)))
        if 13 <= len(d) <= 19 and total % 10 == 0:
            out.append(("card", *m.span()))
    return out + [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15]


def test_base_spans_equal_the_plain_patterns():
    rng = random.Random(3)
    pieces = ["a", "b.c", "@", ".", "-", "_", "%", "+", " ", "1", "255", "256", "0", "4041894974608795", "+1 (724) 555-7058",
              "x@y.z", "10.0.0.1", "é", "١", "(", ")", "\n", "0007.1.2.3", "4041 8949-7460 8795", "@@", "..", "--"]
    for _ in range(30_000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 14)))
        assert P.base_spans(text) == brute(text), text


def test_long_runs_take_linear_time():
    n = 100_000
    for text in ("9" * n, "9." * n, "a" * n + "@", "a@" * n, "+9" + "(" * n, "9-" * n, "+" * n):
        P.base_spans(text)
        P.candidates(text, [])


def test_documents_and_edge_cases(spark):
    data = [(1, "mail é a.b@c.de or 10.0.0.1"), (2, None), (3, ""), (None, "+1 (724) 555-7058"), (1, "4041894974608795")]
    got = {(r.doc_id, r.spans): r for r in P.extract(frame(spark, data)).collect()}
    assert set(got) == {(1, "email:7:15,ip:19:27"), (2, ""), (3, ""), (None, "phone:0:17"), (1, "card:0:16")}
    r = got[1, "email:7:15,ip:19:27"]
    assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == (1, 1, 0, 0)
    assert r.base_sha256 == hashlib.sha256(b"email:7:15,ip:19:27").hexdigest()
    assert P.extract(empty(spark)).count() == 0


def test_trusted_contexts_find_unseen_identifiers(spark):
    """Seeds after "call me" teach the context, which then finds numbers no fixed form knows."""
    data = [(i, f"please call me +1 (724) 555-{1000 + i} thanks {i}") for i in range(30)]
    data += [(100 + i, f"please call me 0049-77{i}-12 thanks") for i in range(3)]
    data += [(200 + i, f"the year {1900 + i} was long and 12345{i} too") for i in range(30)]
    docs = frame(spark, data)
    patterns = P.trusted_patterns(docs)
    assert patterns.get("before call me") == "phone" and not any("year" in p for p in patterns)
    got = {r.doc_id: r.spans for r in P.extract(docs).collect()}
    assert [got[100 + i] for i in range(3)] == ["phone:15:26"] * 3
    assert all(got[200 + i] == "" for i in range(30))
    assert all(got[i] == "phone:15:32" for i in range(30))


def test_a_second_round_follows_patterns_of_found_identifiers(spark):
    """Rounds: an identifier found in a trusted context makes another context count."""
    ids = [f"id-{k}77{k}" for k in range(6)]
    data = [(i, f"reach me at u{i}@mail.example or so") for i in range(40)]
    data += [(100 + i, f"reach me at {x} or so") for i, x in enumerate(ids)]
    docs = frame(spark, data)
    assert P.trusted_patterns(docs, rounds=1).get("before me at") == "email"
    got = {r.doc_id: r.spans for r in P.extract(docs).collect()}
    assert all(got[100 + i] == f"email:12:{12 + len(x)}" for i, x in enumerate(ids))


def test_candidates_with_spaces_and_brackets_are_whole():
    for run in ("(724) 555-7058", "020 7946 095", "4041 8949 7460 8796", "+(44) 20 7946", "020 7946 (095)", "724.555 7058", "(724)555-7058"):
        for text in (f"please call me {run} thanks", f"tel: {run}, or", run, f"id=({run})"):
            at = text.index(run)
            assert (at, at + len(run)) in P.candidates(text, P.base_spans(text)), text
    # Not out of a longer token, not across a fixed form, not too short; tokens stay candidates.
    for text in ("ab12 345678x", "1 2 3", "10.0.0.1 12", "plain text"):
        assert P.digit_runs(text, P.base_spans(text)) == [], text
    assert P.candidates("call 555-7058 12", []) == [(5, 13), (5, 16)]
    for text in ("9 " * 100_000, "9" + "( " * 100_000, "9(" * 100_000, "9 x" * 100_000):
        P.candidates(text, [])


def test_trusted_contexts_find_numbers_with_spaces_and_brackets(spark):
    data = [(i, f"please call me +1 (724) 555-{1000 + i} thanks {i}") for i in range(30)]
    data += [(100, "please call me (724) 555-7058 thanks"), (101, "please call me 020 7946 095 thanks")]
    docs = frame(spark, data)
    for most in (0, 50_000):
        got = {r.doc_id: r.spans for r in P.extract(docs, most=most).collect()}
        assert (got[100], got[101], got[3]) == ("phone:15:29", "phone:15:27", "phone:15:32")
    assert {r.doc_id: r.text for r in P.mask_documents(docs).collect()}[100] == "please call me [PHONE] thanks"


def test_patterns_beyond_the_broadcast_count_too(spark):
    """More trusted patterns than are broadcast: spans and masked texts are the same."""
    leads = ["please call me", "ring us at", "fax goes to", "mobile is now"]
    data = [(100 * k + i, f"{lead} +1 (724) 555-{1000 + i + 50 * k} {lead[:4]}") for k, lead in enumerate(leads) for i in range(9 - k)]
    data += [(1000 + k, f"{lead} 0049-77{k}-12 {lead[:4]}") for k, lead in enumerate(leads)] + [(2000, None), (2001, ""), (1000, leads[0])]
    docs = frame(spark, data)
    for most in (0, 1, 3, 50_000):
        got = sorted((r.doc_id, r.n_phone, r.base_sha256, r.spans) for r in P.extract(docs, most=most).collect())
        assert {i: s for i, _, _, s in got if 1000 < i < 2000} == {1000 + k: f"phone:{len(leads[k]) + 1}:{len(leads[k]) + 12}" for k in (1, 2, 3)}
        texts = sorted((r.doc_id, r.text or "", r.n_chars) for r in P.mask_documents(docs, most=most).collect())
        first = (got, texts) if most == 0 else first
        assert (got, texts) == first and len(texts) == len(data)


def test_masking_keeps_rows_and_columns(spark):
    docs = frame(spark, [(1, "mail a@b.cd now"), (2, None), (3, "clean")])
    got = P.mask_documents(docs)
    assert got.columns == docs.columns
    assert {r.doc_id: (r.text, r.n_chars) for r in got.collect()} == {1: ("mail [EMAIL] now", 16), 2: (None, None), 3: ("clean", 5)}
    assert P.masked("1.2.3.4 x", [("ip", 0, 7), ("card", 2, 9)]) == "[IP]"
