"""Document fingerprints (10): a homomorphic multiset hash of a text's paragraphs.

A fingerprint is a sum of wide vectors, one hashed from each unit of the text,
modulo powers of two: eight lanes modulo 2^64 (equality) and LANES lanes modulo
2^32 whose entries are +1 or -1 (likeness). It does not depend on the order of
the units; adding or taking away a unit is one vector addition, so a text that
changes is fingerprinted again from its changed units alone (``combine``).

Two fingerprints are equal when the texts have the same multiset of units. In the
lanes, the second and later copies of a unit have vectors of their own, so their
scalar product estimates how many units two texts share, copies counted as often
as both have them (each lane is an unbiased estimate), and their cosine is a
likeness from 0 to 1 with an error of about 1/sqrt(LANES); a line that is repeated
a thousand times does not outweigh the rest. A change to copies that are there
already says how many (``after``).

Units are the paragraphs (lines) of the text, cut further after words that their
own characters choose: pieces of LEAST to MOST words, which are found again
whatever was changed before or after them. White space around words does not count.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from datescore.llm.common import RANGES, arrow_schema, column, parallelism, slices, texts_of, to_python

LANES = 512
WIDE = 8
LEAST, MOST = 2, 6  # words of a unit


def units(text: str) -> list[str]:
    """The pieces of a text's paragraphs, each with one space between its words, without empty ones."""
    out = []
    for paragraph in text.split("\n"):
        held: list[str] = []
        for word in paragraph.split():
            held.append(word)
            n = len(held)
            if n >= LEAST and ((ord(word[0]) ^ ord(word[-1]) ^ len(word)) & 1 == 0 or n >= MOST):
                out.append(" ".join(held))
                held = []
        if held:
            out.append(" ".join(held))
    return out


def _digests(texts: list[str]) -> np.ndarray:
    """(n, WIDE) 64-bit words hashed from each text."""
    data = b"".join([hashlib.blake2b(t.encode("utf-8", "surrogatepass"), digest_size=8 * WIDE).digest() for t in texts])
    return np.frombuffer(data, dtype="<u8").reshape(-1, WIDE)


def _signs(words: np.ndarray, copy: np.ndarray) -> np.ndarray:
    """(n, LANES) bits for the ``copy``-th copy (from 0) of units with these words."""
    z = words + (copy.astype(np.uint64)[:, None] + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return np.unpackbits((z ^ (z >> np.uint64(31))).view(np.uint8), axis=1)


def fingerprints(texts: list[str], after: list[Counter] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of many texts: (n, WIDE) words modulo 2^64 and (n, LANES) lanes modulo 2^32.

    ``after``: for each text, the copies of units that are there before its own.
    """
    names: dict[str, int] = {}
    unit, copy, counts = [], [], []
    for k, text in enumerate(texts):
        seen = dict(after[k]) if after else {}
        own = units(text)
        counts.append(len(own))
        for u in own:
            unit.append(names.setdefault(u, len(names)))
            n = seen.get(u, 0)
            copy.append(n)
            seen[u] = n + 1
    words = np.zeros((len(texts), WIDE), dtype=np.uint64)
    lanes = np.zeros((len(texts), LANES), dtype=np.int32)
    if not unit:
        return words, lanes
    digests = _digests(list(names))
    at, number = np.array(unit), np.array(copy)
    starts = np.cumsum(counts) - counts
    # A few texts at a time: the bits of one unit are LANES bytes.
    for first, last in _stretches(np.array(counts), 1 << 14):
        some = np.flatnonzero(np.array(counts[first:last])) + first
        if not len(some):
            continue
        lo, hi = starts[first], starts[last - 1] + counts[last - 1]
        cut = starts[some] - lo
        words[some] = np.add.reduceat(digests[at[lo:hi]], cut, axis=0)
        lanes[some] = _sums(digests, at[lo:hi], number[lo:hi], cut)
    return words, lanes


def _stretches(counts: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Runs of texts with at most ``limit`` units together (or one text)."""
    first, held = 0, 0
    for k, n in enumerate(counts.tolist()):
        if k > first and held + n > limit:
            yield first, k
            first, held = k, 0
        held += n
    yield first, len(counts)


def _sums(digests: np.ndarray, at: np.ndarray, number: np.ndarray, cut: np.ndarray) -> np.ndarray:
    """Lanes of texts whose units begin at ``cut``: +1 for each bit set, -1 for each that is not; in pieces of units."""
    out = np.zeros((len(cut), LANES), dtype=np.int32)
    step = 1 << 14
    for lo in range(0, len(at), step):
        hi = min(lo + step, len(at))
        bits = _signs(digests[at[lo:hi]], number[lo:hi])
        inside = np.unique(np.maximum(cut[cut < hi], lo)) - lo
        first = int(np.searchsorted(cut, lo, side="right")) - 1
        sums = np.add.reduceat(bits, inside, axis=0, dtype=np.int32)
        n = np.diff(np.append(inside, hi - lo)).astype(np.int32)
        out[max(first, 0) : max(first, 0) + len(inside)] += 2 * sums - n[:, None]
    return out


def combine(a: tuple, b: tuple, sign: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints after inserting (sign 1) or deleting (sign -1) the units of ``b``.

    Where ``a`` has copies of these units, ``b`` is made ``after`` those that stay.
    """
    if sign == 1:
        return a[0] + b[0], a[1] + b[1]
    return a[0] - b[0], a[1] - b[1]


def as_text(words: np.ndarray, lanes: np.ndarray) -> list[str]:
    """Lowercase hex: the wide words, then the lanes."""
    both = np.concatenate([words.view(np.uint8).reshape(len(words), -1), lanes.astype("<i4").view(np.uint8).reshape(len(lanes), -1)], axis=1)
    return [row.tobytes().hex() for row in both]


def from_text(text: str) -> tuple[np.ndarray, np.ndarray]:
    data = bytes.fromhex(text)
    return np.frombuffer(data[: WIDE * 8], "<u8")[None].copy(), np.frombuffer(data[WIDE * 8 :], "<i4")[None].copy()


def likeness(a: tuple, b: tuple) -> np.ndarray:
    """1 for equal fingerprints, else the cosine of the lanes between 0 and just under 1; no units on one side: 0."""
    same = (a[0] == b[0]).all(axis=1) & (a[1] == b[1]).all(axis=1)
    x, y = a[1].astype(np.float64), b[1].astype(np.float64)
    norm = np.sqrt((x * x).sum(axis=1) * (y * y).sum(axis=1))
    cosine = np.divide((x * y).sum(axis=1), norm, out=np.zeros(len(x)), where=norm > 0)
    return np.where(same, 1.0, np.clip(cosine, 0.0, 1.0 - 2.0**-20))


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """doc_id and fingerprint of every row. Null text counts as empty: the zero fingerprint."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            yield pa.RecordBatch.from_arrays(
                [column(batch, "doc_id"), pa.array(as_text(*fingerprints(texts_of(batch))))], ["doc_id", "fingerprint"]
            )

    return to_python(docs.select("doc_id", "text")).mapInArrow(run, "doc_id bigint, fingerprint string")


# --- the next document ----------------------------------------------------------------


def _ranges(docs: DataFrame, parts: int) -> tuple[list[int], dict[int, int | None]]:
    """Split points of doc_id and the largest doc_id of each range that holds rows.

    At most ``parts`` + 1 numbers on the driver. Any split points give the same
    result; they only balance the ranges.
    """
    ids = docs.select("doc_id")
    fractions = [i / parts for i in range(1, parts)]
    cuts = ids.agg(F.percentile_approx("doc_id", fractions, max(10_000, 10 * parts))).first()[0] if fractions else []
    cuts = sorted(set(cuts or []))
    heads = ids.groupBy(_range_of(cuts)(F.col("doc_id")).alias("part")).agg(F.max("doc_id").alias("head")).collect()
    return cuts, {r.part: r.head for r in heads}


def _range_of(cuts: list[int]):
    """Range number of a doc_id: 0 for null, then upwards by the split points."""
    at = np.array(cuts, dtype=np.int64)

    @F.pandas_udf("int")
    def part(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(at, ids.to_numpy(), side="left") + 1, dtype="int32")

    return lambda ids: F.when(ids.isNull(), 0).otherwise(part(F.coalesce(ids, F.lit(0).cast("long"))))


def with_next(docs: DataFrame, apply, schema: str) -> DataFrame:
    """``apply`` (for mapInArrow) over doc_id, text, part, guest in descending doc_id.

    One scan and one shuffle of the texts: documents are dealt by range of
    doc_id and sorted inside it. The first document of each range also goes,
    as a guest, behind the last document of the range above; the first of
    all goes behind the last of all.
    """
    spark = docs.sparkSession
    cuts, heads = _ranges(docs, RANGES * parallelism(spark))
    full = sorted(heads, reverse=True)
    # One row per range at most: a bounded broadcast.
    guests = spark.createDataFrame(
        [(below, heads[below], here) for here, below in zip(full, full[1:] + full[:1])], "of int, head bigint, above int"
    )
    mine = docs.select("doc_id", "text").withColumn("at", _range_of(cuts)(F.col("doc_id")))
    on = (F.col("at") == F.col("of")) & F.col("doc_id").eqNullSafe(F.col("head"))
    own = F.struct(F.col("at").alias("part"), F.lit(False).alias("guest"))
    also = F.struct(F.col("above").alias("part"), F.lit(True).alias("guest"))
    places = F.when(F.col("above").isNull(), F.array(own)).otherwise(F.array(own, also))
    sent = mine.join(F.broadcast(guests), on, "left").select("doc_id", "text", F.inline(places))
    dealt = sent.repartition(parallelism(spark), "part").sortWithinPartitions(
        F.desc("part"), F.asc("guest"), F.desc_nulls_last("doc_id"), F.asc("text")
    )
    return to_python(dealt).mapInArrow(apply, schema)


RESULT = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string,"
    " near_edited double, near_next double"
)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each document against the one that follows it in the stream; a guest only follows."""
    schema = arrow_schema(RESULT)
    held = None  # the last document so far: (doc_id, text, part, fingerprint, guest)
    for batch in slices(batches, "text"):
        texts = texts_of(batch)
        ids = column(batch, "doc_id").to_pylist()
        parts, guests = column(batch, "part").to_pylist(), column(batch, "guest").to_pylist()
        words, lanes = fingerprints(texts)
        rows = [] if held is None else [held]
        rows += [
            (i, t, p, (words[k : k + 1], lanes[k : k + 1]), g) for k, (i, t, p, g) in enumerate(zip(ids, texts, parts, guests))
        ]
        pairs = [(a, b) for a, b in zip(rows, rows[1:]) if a[2] == b[2] and not a[4]]
        held = rows[-1]
        if pairs:
            yield _pairs(pairs, schema)


def _pairs(pairs: list, schema: pa.Schema) -> pa.RecordBatch:
    edited = []
    for (_, text, *_), (_, following, *_) in pairs:
        half = len(text) // 2
        edited.append(text[: len(text) - half] + following[:half])
    own = tuple(np.concatenate([a[3][k] for a, _ in pairs]) for k in (0, 1))
    following = tuple(np.concatenate([b[3][k] for _, b in pairs]) for k in (0, 1))
    changed = fingerprints(edited)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([a[0] for a, _ in pairs], pa.int64()),
            pa.array([len(a[1]) for a, _ in pairs], pa.int64()),
            pa.array([hashlib.sha256(e.encode()).hexdigest() for e in edited], pa.string()),
            pa.array(as_text(*own), pa.string()),
            pa.array(as_text(*changed), pa.string()),
            pa.array(likeness(own, changed)),
            pa.array(likeness(own, following)),
        ],
        schema=schema,
    )


def compare_edits(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Fingerprints of every document and of its edited text, and their likeness.

    Edited: the last floor(n_chars / 2) code points are replaced by the first
    as many of the next document in descending doc_id (after the last: the
    first). Null text counts as empty, a null doc_id comes last; rows that
    repeat a doc_id follow each other in the order of their texts; a table of
    one row follows itself; an empty table gives an empty result. Columns
    other than doc_id and text are not read.
    """
    return with_next(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), _compare, RESULT)
