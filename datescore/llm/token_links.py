"""Cross-tokenizer alignment with inverted pair bitmaps (12).

Both tokenizers cut the same bytes, so between two neighbouring token ends (of
either) lies a piece of one token of A and one of B: each such piece is one link.
Offsets where both end cut the tokens into groups.

A task numbers its documents within chunks of bounded text. For every id pair of
a chunk it writes a posting: a compressed bitmap of the documents that hold the
pair linked (sorted 16-bit numbers, or plain bits where these are shorter), and
multiplicity planes, bit k of the number of links for each of these documents.
Slices of a chunk are OR-merged into its postings; the chunk's postings of a pair
are its containers, and their popcounts add up to its number of documents. These
counts, and whether they are the highest of their A id, are joined back to the
postings, which return to their chunk and give each document its scores.

One link is never a row: what is shuffled is one row for each pair and chunk.
A pair has one posting a chunk at most, so none is hot; a group of ``decode`` is
a chunk, bounded by CHUNK_TEXT and the longest text.

Defined results: a text that is null, empty or not given back by both tokenizers
has zeros and an empty ``groups_sha256``. Repeated rows and ids are documents of
their own, and each counts in its pairs. An empty table gives no rows. Other
columns are not read.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from datescore.llm.bpe import default_pattern
from datescore.llm.common import column, release, slices, texts_of, to_python, tokenizer_bytes, tokenizer_path, written
from datescore.llm.packing import TokenIds, _byte_alphabet

CHUNK_TEXT = 8 << 20  # bytes of text in a chunk (and one text more)
CHUNK_ROWS = 1 << 16  # documents in a chunk: their numbers have 16 bits
SLICE = 1 << 18

DIGITS = 8  # of an id in a group string, with the sign after it


class Tokenizers:
    """Ids of both tokenizers and the bytes of their tokens."""

    def __init__(self, vocab: bytes, model: bytes, pattern: str):
        import sentencepiece

        self.a, self.slow = TokenIds(vocab, pattern), None
        byte = _byte_alphabet()
        spec = json.loads(vocab)
        ids = {i: t for t, i in spec["model"]["vocab"].items()}
        self.a_bytes = [bytes(byte[c] for c in ids.get(i, "") if c in byte) for i in range(max(ids) + 1)]
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.b_bytes = [
            bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()
            for i, piece in ((i, self.b.id_to_piece(i)) for i in range(self.b.get_piece_size()))
        ]
        self.a_length = np.array([len(t) for t in self.a_bytes], dtype=np.int64)
        self.b_length = np.array([len(t) for t in self.b_bytes], dtype=np.int64)
        self.decimals = decimals(max(len(self.a_bytes), len(self.b_bytes)))

    def a_ids(self, text: str) -> np.ndarray:
        """Ids of A; the contents of added tokens are plain text."""
        if self.a.fast is not None:
            return self.a.fast.encode_to_numpy(text, disallowed_special=()).astype(np.int64)
        if self.slow is None:
            from tokenizers import Tokenizer

            self.slow = Tokenizer.from_str(self.a.data.decode())
            self.slow.encode_special_tokens = True
        return np.array(self.slow.encode(text, add_special_tokens=False).ids, dtype=np.int64)

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of A (of a space and the text) and of B, or None where their bytes are not a space and the text."""
        if not text:
            return None
        data = (" " + text).encode()
        a = self.a_ids(" " + text)
        if b"".join(map(self.a_bytes.__getitem__, a.tolist())) != data:
            return None
        b = self.b.encode(text, num_threads=1)
        if b"".join(map(self.b_bytes.__getitem__, b)) != data:
            return None
        return a, np.array(b, dtype=np.int64)


@lru_cache(maxsize=1)
def _tokenizers(vocab: bytes, model: bytes, pattern: str) -> Tokenizers:
    return Tokenizers(vocab, model, pattern)


def align(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links as positions (in A, in B), and the offsets where both end."""
    ends = np.sort(np.concatenate([a_ends, b_ends]))
    again = ends[1:] == ends[:-1]
    both = ends[1:][again]
    ends = ends[np.append(True, ~again)]
    return np.searchsorted(a_ends, ends), np.searchsorted(b_ends, ends), both


def decimals(size: int) -> tuple[np.ndarray, np.ndarray]:
    """The decimal digits of 0 .. size - 1, one row each, and how many there are."""
    texts = np.array([str(i) for i in range(size)], dtype=f"S{DIGITS}")
    return texts.view(np.uint8).reshape(size, DIGITS), np.char.str_len(texts)


def group_text(
    a: np.ndarray, b: np.ndarray, a_ends: np.ndarray, b_ends: np.ndarray, both: np.ndarray, table: tuple[np.ndarray, np.ndarray]
) -> bytes:
    """``a1,a2|b1;a3|b2,b3``: the ids of A and B, group by group; ``table``: their ``decimals``."""
    a_cut, b_cut = np.searchsorted(a_ends, both) + 1, np.searchsorted(b_ends, both) + 1
    n = len(a) + len(b)
    ids, sign = np.empty(n, dtype=np.int64), np.full(n, ord(","), dtype=np.uint8)
    # A token of A stands after the B tokens of earlier groups, one of B after the A tokens up to its group.
    a_at = np.arange(len(a)) + np.append(0, b_cut)[np.searchsorted(both, a_ends)]
    b_at = np.arange(len(b)) + a_cut[np.searchsorted(both, b_ends)]
    ids[a_at], ids[b_at] = a, b
    sign[a_at[a_cut - 1]], sign[b_at[b_cut - 1]] = ord("|"), ord(";")
    digits, length = table
    rows = np.zeros((n, DIGITS + 1), dtype=np.uint8)
    rows[:, :DIGITS] = digits[ids]
    rows[np.arange(n), length[ids]] = sign
    return rows[rows != 0].tobytes()[:-1]


# --- postings ---------------------------------------------------------------------------


def pack(number: np.ndarray, first: np.ndarray, rows: int) -> tuple[pa.Array, pa.Array]:
    """Compressed bitmaps of document numbers, sorted within each posting; ``first``: where postings begin.

    Returns the containers and whether they are plain bits (else 16-bit numbers).
    """
    n = np.diff(np.append(first, len(number)))
    bits = -(-rows // 8)
    dense = 2 * n > bits
    offsets = np.concatenate([[0], np.cumsum(np.where(dense, bits, 2 * n))])
    out = np.zeros(offsets[-1], dtype=np.uint8)
    posting = np.repeat(np.arange(len(n)), n)
    rank = np.arange(len(number)) - np.repeat(first, n)
    of_dense = dense[posting]
    at = offsets[posting[~of_dense]] + 2 * rank[~of_dense]
    out[at], out[at + 1] = number[~of_dense] & 255, number[~of_dense] >> 8
    some = number[of_dense]
    np.bitwise_or.at(out, offsets[posting[of_dense]] + (some >> 3), (1 << (some & 7)).astype(np.uint8))
    return _binary(out, offsets), pa.array(dense)


def planes(count: np.ndarray, first: np.ndarray) -> pa.Array:
    """Multiplicity planes: for each bit of a posting's highest count, one bit for each of its documents.

    Empty where all counts are 1.
    """
    n = np.diff(np.append(first, len(count)))
    if not len(n):
        return pa.array([], pa.binary())
    deep = np.ceil(np.log2(np.maximum.reduceat(count, first) + 1)).astype(np.int64)
    deep[deep == 1] = 0
    width = -(-n // 8)
    offsets = np.concatenate([[0], np.cumsum(deep * width)])
    out = np.zeros(offsets[-1], dtype=np.uint8)
    posting = np.repeat(np.arange(len(n)), n)
    rank = np.arange(len(count)) - np.repeat(first, n)
    for k in range(int(deep.max())):
        has = np.flatnonzero((count >> k & 1).astype(bool) & (deep[posting] > k))
        of = posting[has]
        np.bitwise_or.at(out, offsets[of] + k * width[of] + (rank[has] >> 3), (1 << (rank[has] & 7)).astype(np.uint8))
    return _binary(out, offsets)


def _binary(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.BinaryArray.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int32).tobytes()), pa.py_buffer(data.tobytes())])


def _buffers(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Data and the ``n + 1`` offsets of a binary array."""
    _, offsets, data = values.buffers()
    at = np.frombuffer(offsets, dtype=np.int32)[values.offset : values.offset + len(values) + 1].astype(np.int64)
    return np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8), at


def _spread(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... (size[0] of them), start[1], ..."""
    return np.repeat(start - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))


def unpack(containers: pa.Array, dense: np.ndarray, deep: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(posting, document number, number of links) of all postings."""
    data, at = _buffers(containers)
    size = np.diff(at)
    sparse = np.flatnonzero(~dense)
    low = _spread(at[sparse], size[sparse])[0::2]
    number = [data[low].astype(np.int64) | data[low + 1].astype(np.int64) << 8]
    posting = [np.repeat(sparse, size[sparse] // 2)]
    plain = np.flatnonzero(dense)
    bits = np.unpackbits(data[_spread(at[plain], size[plain])], bitorder="little")
    ones = np.flatnonzero(bits)
    ends = np.cumsum(size[plain] * 8)
    of = np.searchsorted(ends, ones, side="right")
    number.append(ones - (ends - size[plain] * 8)[of])
    posting.append(plain[of])
    number, posting = np.concatenate(number), np.concatenate(posting)
    n = np.bincount(posting, minlength=len(containers))
    order = np.argsort(posting, kind="stable")
    posting, number = posting[order], number[order]
    rank = np.arange(len(posting)) - np.repeat(np.cumsum(n) - n, n)
    data, at = _buffers(deep)
    width = -(-n // 8)
    levels = np.diff(at) // np.maximum(width, 1)
    count = np.where(levels[posting] == 0, 1, 0).astype(np.int64)
    for k in range(int(levels.max(initial=0))):
        has = np.flatnonzero(levels[posting] > k)
        where = at[posting[has]] + k * width[posting[has]] + (rank[has] >> 3)
        count[has] |= (data[where] >> (rank[has] & 7) & 1).astype(np.int64) << k
    return posting, number, count


# A row is a document (its counts) or a posting (its pair and bitmaps).
ROWS = pa.schema(
    [("chunk", pa.int64()), ("doc_id", pa.int64()), ("number", pa.int32()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
     ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("a", pa.int32()), ("b", pa.int32()), ("docs", pa.binary()), ("dense", pa.bool_()),
     ("planes", pa.binary())]
)
ROWS_DDL = (
    "chunk bigint, doc_id bigint, number int, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string,"
    " a int, b int, docs binary, dense boolean, planes binary"
)


def _rows(n: int, values: dict[str, pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([values[f.name] if f.name in values else pa.nulls(n, f.type) for f in ROWS], schema=ROWS)


class _Chunk:
    """Documents of a task that share numbers, and their linked pairs so far."""

    def __init__(self, chunk: int, b_size: int):
        self.chunk, self.b_size = chunk, b_size
        self.facts: list[tuple] = []
        self.pairs: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.bytes = 0

    def add(self, doc_ids: list, texts: list[str], tokenizers: Tokenizers) -> None:
        keys = []
        for doc_id, text in zip(doc_ids, texts):
            number = len(self.facts)
            self.bytes += len(text)
            ids = tokenizers.encode(text)
            if ids is None:
                self.facts.append((doc_id, number, 0, 0, 0, 0, ""))
                continue
            a, b = ids
            a_ends, b_ends = np.cumsum(tokenizers.a_length[a]), np.cumsum(tokenizers.b_length[b])
            i, j, both = align(a_ends, b_ends)
            digest = hashlib.sha256(group_text(a, b, a_ends, b_ends, both, tokenizers.decimals)).hexdigest()
            self.facts.append((doc_id, number, len(a), len(b), len(both), len(i), digest))
            keys.append((a[i] * self.b_size + b[j]) << 16 | number)
        if keys:
            entries = np.sort(np.concatenate(keys))
            first = np.flatnonzero(np.append(True, entries[1:] != entries[:-1]))
            self.pairs.append(entries[first])
            self.counts.append(np.diff(np.append(first, len(entries))))

    def batches(self) -> Iterator[pa.RecordBatch]:
        """The rows of the documents, then of the postings (documents OR-merged for each pair)."""
        n = len(self.facts)
        names = ("doc_id", "number", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
        facts = {name: pa.array(v, ROWS.field(name).type) for name, v in zip(names, zip(*self.facts))}
        yield _rows(n, facts | {"chunk": pa.array([self.chunk] * n, pa.int64())})
        if not self.pairs:
            return
        entries, counts = np.concatenate(self.pairs), np.concatenate(self.counts)
        order = np.argsort(entries, kind="stable")  # a document lies in one slice: entries differ
        entries, counts = entries[order], counts[order]
        number, pair = entries & 0xFFFF, entries >> 16
        first = np.flatnonzero(np.append(True, pair[1:] != pair[:-1]))
        docs, dense = pack(number, first, n)
        values = {
            "chunk": pa.array(np.full(len(first), self.chunk)),
            "a": pa.array((pair[first] // self.b_size).astype(np.int32)),
            "b": pa.array((pair[first] % self.b_size).astype(np.int32)),
            "docs": docs,
            "dense": dense,
            "planes": planes(counts, first),
        }
        whole = _rows(len(first), values)
        for start in range(0, len(first), 10_000):
            yield whole.slice(start, 10_000)


def postings(docs: DataFrame, vocab_path: str | None = None, model_path: str | None = None) -> DataFrame:
    """Rows of documents and of postings (ROWS); to be written once, as chunk numbers go with the tasks."""
    context = docs.sparkSession.sparkContext
    vocab = context.broadcast(tokenizer_bytes(vocab_path or tokenizer_path("byte_bpe_50k.json")))
    model = context.broadcast(tokenizer_bytes(model_path or tokenizer_path("piece_bpe_32k.model")))
    pattern = default_pattern()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizers = _tokenizers(vocab.value, model.value, pattern)
        size = len(tokenizers.b_bytes)
        numbers = iter(range(TaskContext.get().partitionId() << 32, 1 << 62))
        held = _Chunk(next(numbers), size)
        for batch in slices(batches, "text", SLICE):
            if held.facts and (held.bytes >= CHUNK_TEXT or len(held.facts) + batch.num_rows > CHUNK_ROWS):
                yield from held.batches()
                held = _Chunk(next(numbers), size)
            held.add(column(batch, "doc_id").to_pylist(), texts_of(batch), tokenizers)
        if held.facts:
            yield from held.batches()
        release()

    return to_python(docs.select("doc_id", "text")).mapInArrow(run, ROWS_DDL)


def pair_counts(rows: DataFrame) -> DataFrame:
    """(a, b, documents, links, best): of every linked pair, over all chunks; best: the highest of its A id."""
    n = F.when(F.col("dense"), F.bitmap_count("docs")).otherwise(F.octet_length("docs") / 2).cast("bigint")
    counts = rows.where(F.col("docs").isNotNull()).groupBy("a", "b").agg(F.sum(n).alias("documents"))
    # At most as many rows for an A id as B has tokens.
    highest = F.max("documents").over(Window.partitionBy("a"))
    return counts.withColumn("best", F.col("documents") == highest)


SCORES = (
    "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"
)
_SCORES = ("doc_id", "n_a", "n_b", "n_groups", "n_links")


def _decode(table: pa.Table) -> pa.Table:
    """The documents of a chunk with the scores that its postings return."""
    table = table.combine_chunks()
    is_doc = table.column("docs").is_null()
    facts = table.filter(is_doc).sort_by("number")
    found = table.filter(pc.invert(is_doc))
    best, total = np.zeros(facts.num_rows, dtype=np.int64), np.zeros(facts.num_rows, dtype=np.int64)
    for batch in found.to_batches(max_chunksize=5_000):
        posting, number, count = unpack(column(batch, "docs"), column(batch, "dense").to_numpy(zero_copy_only=False), column(batch, "planes"))
        documents = column(batch, "documents").to_numpy()
        is_best = column(batch, "best").to_numpy(zero_copy_only=False)
        np.add.at(total, number, documents[posting] * count)
        np.add.at(best, number, is_best[posting] * count)
    return pa.table(
        {c: facts.column(c) for c in _SCORES} | {"n_best": pa.array(best), "count_sum": pa.array(total), "groups_sha256": facts.column("groups_sha256")}
    )


def link_scores(docs: DataFrame, vocab_path: str | None = None, model_path: str | None = None) -> DataFrame:
    """Per document: tokens of both, groups, links, links that are their A id's best, the sum of the links' counts."""
    rows = written(postings(docs, vocab_path, model_path), "token-postings")
    counted = rows.where(F.col("docs").isNotNull()).join(pair_counts(rows), ["a", "b"])
    names = ["chunk", "doc_id", "number", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "docs", "dense", "planes"]
    facts = rows.where(F.col("docs").isNull()).select(*names, F.lit(None).cast("bigint").alias("documents"), F.lit(None).cast("boolean").alias("best"))
    both = facts.unionByName(counted.select(*names, "documents", "best"))
    return both.groupBy("chunk").applyInArrow(_decode, SCORES)
