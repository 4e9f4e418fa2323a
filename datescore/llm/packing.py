"""Packing (8): sequences of a fixed window from documents of all lengths.

A document's ids end with one end id. It is cut into whole windows and a tail;
the tails' length histogram (window - 1 numbers) is packed by non-negative
least squares: the combinations of two or three lengths that fill a window
exactly are the columns, the histogram is the right-hand side, and the
solution, rounded down to what the histogram allows, says how often each
combination is used. What is left is packed greedily, longest first, each
sequence filled with the longest lengths that still fit.

The plan is made on histogram counts alone: its size depends on the window, not
on the number of documents. Pieces of one length are interchangeable; each is
ranked within its length (in sub-buckets by hash, no single-task window) and
the plan's intervals of ranks give its sequence and offset. Texts are read and
tokenized once; what Spark shuffles is one short row for each piece.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from datescore.llm.bpe import default_pattern
from datescore.llm.common import (
    arrow_schema,
    column,
    ranked,
    repeat_rows,
    slices,
    texts_of,
    to_python,
    tokenizer_bytes,
    tokenizer_path,
    written,
)

WINDOW = 1024
END_ID = 0
SUB_BUCKETS = 128
ROUNDS = 300  # of the least-squares solver


# --- ids ------------------------------------------------------------------------------


def _byte_alphabet() -> dict[str, int]:
    """The printable stand-ins that byte-level vocabularies use for the 256 bytes."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class TokenIds:
    """Ids of a byte-level ``tokenizers`` file, without its special post-processing.

    Where the merges are in the order of their ids (so that ids are ranks),
    ordinary text goes through ``tiktoken``, which gives the same ids several
    times faster; texts with an added token's content, and files of another
    kind, go through ``tokenizers`` itself.
    """

    def __init__(self, data: bytes, pattern: str):
        spec = json.loads(data)
        self.data, self.tokenizer = data, None
        self.added = [t["content"] for t in spec.get("added_tokens") or []]
        self.fast = None
        model, pre = spec["model"], spec.get("pre_tokenizer") or {}
        merges = [m if isinstance(m, str) else " ".join(m) for m in model.get("merges", [])]
        ids = [model["vocab"].get(m.replace(" ", "", 1)) for m in merges]
        plain = spec.get("normalizer") is None and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space")
        if plain and ids and None not in ids and ids == sorted(ids):
            import tiktoken

            byte = _byte_alphabet()
            ranks = {bytes(byte[c] for c in t): i for t, i in model["vocab"].items() if t not in self.added}
            self.fast = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def __call__(self, text: str) -> np.ndarray:
        if self.fast is None or any(a in text for a in self.added):
            if self.tokenizer is None:  # made only where it is needed: it is large
                from tokenizers import Tokenizer

                self.tokenizer = Tokenizer.from_str(self.data.decode())
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4")
        return np.asarray(self.fast.encode_to_numpy(text, disallowed_special=()), dtype="<u4")


@lru_cache(maxsize=2)
def _ids(data: bytes, pattern: str) -> TokenIds:
    return TokenIds(data, pattern)


PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"


def pieces(
    docs: DataFrame, vocab_path: str | None = None, window: int = WINDOW, end_id: int = END_ID, with_ids: bool = False
) -> DataFrame:
    """Every document cut into whole windows and a tail.

    ``with_ids`` adds the ids themselves (little-endian unsigned 32-bit).
    Null and empty texts are the end id alone.
    """
    vocab = docs.sparkSession.sparkContext.broadcast(tokenizer_bytes(vocab_path or tokenizer_path("byte_bpe_50k.json")))
    pattern = default_pattern()
    ddl = PIECES + (", ids binary" if with_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = _ids(vocab.value, pattern)
        schema = arrow_schema(ddl)
        end = np.array([end_id], dtype="<u4").tobytes()
        for batch in slices(batches, "text"):
            rows = []
            for doc_id, text in zip(column(batch, "doc_id").to_pylist(), texts_of(batch)):
                data = (ids_of(text).tobytes() if text else b"") + end
                total = len(data) // 4
                for start in range(0, total, window):
                    part = data[4 * start : 4 * (start + window)]
                    rows.append((doc_id, start, len(part) // 4, zlib.crc32(part), total, part)[: len(schema)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(values, field.type) for values, field in zip(zip(*rows), schema)], schema=schema
            )

    return to_python(docs.select("doc_id", "text")).mapInArrow(run, ddl)


# --- the plan ---------------------------------------------------------------------------


def combinations(window: int) -> np.ndarray:
    """All combinations of two or three lengths that fill the window: (n, 3) lengths, 0 for none."""
    pairs = [(a, window - a, 0) for a in range(1, window // 2 + 1)]
    triples = []
    for a in range(1, window // 3 + 1):
        b = np.arange(a, (window - a) // 2 + 1)
        triples.append(np.stack([np.full_like(b, a), b, window - a - b], axis=1))
    return np.concatenate([np.array(pairs).reshape(-1, 3), *triples])


def solve(columns: np.ndarray, histogram: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Repeat counts x >= 0 that minimise |A x - histogram|^2 (accelerated projected gradient).

    A's entry is how often a length stands in a combination; it is applied by
    gathers and weighted counts, never built.
    """
    size = len(histogram)
    slots = [columns[:, j] for j in range(columns.shape[1])]

    def apply(x):
        out = sum(np.bincount(s, weights=x, minlength=size) for s in slots)
        out[0] = 0
        return out

    def transpose(r):
        r = r.copy()
        r[0] = 0
        return sum(r[s] for s in slots)

    h = histogram.astype(np.float64).copy()
    h[0] = 0
    v = np.ones(len(columns))
    for _ in range(20):
        w = transpose(apply(v))
        norm = np.linalg.norm(w)
        v = w / norm
    step = 1.0 / (norm * 1.05)
    x = y = np.zeros(len(columns))
    t = 1.0
    for _ in range(rounds):
        nxt = np.maximum(0.0, y - step * transpose(apply(y) - h))
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = nxt + (t - 1) / t2 * (nxt - x)
        x, t = nxt, t2
    return x


def plan(histogram: np.ndarray, window: int = WINDOW) -> list[tuple[tuple[int, ...], int]]:
    """Patterns (lengths) and how often each is used; together they use every piece of ``histogram`` once.

    ``histogram[l]`` is the number of pieces of length l, 1 to ``window``.
    """
    left = histogram.astype(np.int64).copy()
    out = []
    if left[window]:
        out.append(((window,), int(left[window])))
        left[window] = 0
    columns = combinations(window)
    present = np.where(columns > 0, left[columns] > 0, True).all(axis=1)
    columns = columns[present]
    if len(columns):
        x = solve(columns, left[:window])
        for k in np.argsort(-x, kind="stable"):
            if x[k] < 0.5:
                break
            lengths = tuple(int(v) for v in columns[k] if v)
            times = min([round(x[k])] + [int(left[v]) // lengths.count(v) for v in set(lengths)])
            if times > 0:
                out.append((lengths, times))
                for v in lengths:
                    left[v] -= times
    # Residuals: longest first, filled with the longest that fit; each pattern as often as its lengths last.
    while left.any():
        room, lengths, rest = window, [], left.copy()
        while room:
            fits = np.flatnonzero(rest[: room + 1])
            if not len(fits):
                break
            v = int(fits[-1])
            lengths.append(v)
            rest[v] -= 1
            room -= v
        times = min(int(left[v]) // lengths.count(v) for v in set(lengths))
        out.append((tuple(lengths), times))
        for v in lengths:
            left[v] -= times
    return out


def intervals(patterns: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, end rank, sequence of the first, offset) for each slot of each pattern."""
    used: dict[int, int] = {}
    out, sequence = [], 0
    for lengths, times in patterns:
        offset = 0
        for v in lengths:
            first = used.get(v, 0)
            out.append((v, first, first + times, sequence, offset))
            used[v] = first + times
            offset += v
        sequence += times
    return out


# --- packing ----------------------------------------------------------------------------


def pack(cut: DataFrame, window: int = WINDOW) -> DataFrame:
    """``cut`` (doc_id, start, length and more columns) with sequence_id and offset.

    Every piece gets one place; lengths must be 1 to ``window``. Rows that repeat in full are
    counted before the shuffle and get places of their own. An empty table gives an empty result.
    """
    spark = cut.sparkSession
    names = cut.columns
    rows = cut.groupBy(*names).agg(F.count(F.lit(1)).alias("_copies"))
    rows = rows.withColumn("_h", F.xxhash64("doc_id", "start"))
    rows = rows.withColumn("_sub", F.pmod("_h", F.lit(SUB_BUCKETS)).cast("int"))
    order = ["_h", *names]
    placed, totals = ranked(rows, "length", "_copies", order, "_sub", "_rank")
    histogram = np.zeros(window + 1, dtype=np.int64)
    for length, total in totals.collect():  # one row per length
        histogram[length] = total
    table = spark.createDataFrame(intervals(plan(histogram, window)), "length bigint, _first long, _end long, _seq long, offset long")
    last = F.col("_rank") + F.col("_copies")
    start = F.greatest("_rank", "_first")
    # The number of intervals depends on the window alone: a bounded broadcast.
    cut_up = placed.join(F.broadcast(table), "length").where((F.col("_rank") < F.col("_end")) & (last > F.col("_first")))
    cut_up = cut_up.select(
        *names,
        (F.col("_seq") + start - F.col("_first")).alias("sequence_id"),
        "offset",
        (F.least(last, F.col("_end")) - start).alias("_copies"),
    )
    return repeat_rows(cut_up, "_copies", "sequence_id").drop("_copies")


def pack_documents(docs: DataFrame, vocab_path: str | None = None, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """Pieces of every document with their places: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Null and empty texts are one piece of one id. Repeated and null doc_ids
    are documents like any other; other columns are not read.
    """
    cut = written(pieces(docs, vocab_path, window, end_id), "pieces")
    return pack(cut, window).select(*[f.split()[0] for f in PIECES.split(", ")], "sequence_id", "offset")


def token_sequences(docs: DataFrame, vocab_path: str | None = None, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """The sequences themselves: sequence_id, length, ids (little-endian unsigned 32-bit, not padded)."""
    cut = written(pieces(docs, vocab_path, window, end_id, with_ids=True), "pieces")
    placed = pack(cut, window)
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))  # at most a window of ids
    joined = F.unhex(F.array_join(F.transform(F.col("parts"), lambda p: F.hex(p["ids"])), ""))
    grouped = placed.groupBy("sequence_id").agg(F.sum("length").alias("length"), parts.alias("parts"))
    return grouped.select("sequence_id", "length", joined.alias("ids"))
