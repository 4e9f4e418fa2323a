"""Byte-level BPE encoding and decoding (3).

Encoding runs the merges of a rank file exactly, without running them: an
Aho-Corasick automaton over the tokens (bytes as Latin-1 text) finds the
longest token at every position, and a backtracking pass keeps a sequence in
which every two neighbours are compatible, i.e. merging their joined bytes
gives just these two tokens back. Such a sequence is the result of the
merges, and there is only one. A position found to lead nowhere is marked and
never entered again, so the pass is linear in the length of the piece.

Pieces are the matches of the pre-tokenizer's pattern. A space followed by a
character that is not white space always begins a piece, so a text is cut
there first and the ids of each chunk are memoised. The memo of chunks is two
generations of fixed size (what is used again moves to the younger), that of
neighbours is emptied at a fixed size, so a task's memory is bounded.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame

from datescore.llm.common import arrow_schema, column, slices, texts_of, to_python, tokenizer_bytes, tokenizer_path

CHUNKS = 250_000  # chunks in a generation of the memo; two generations are held
PAIRS = 400_000  # neighbour decisions memoised in a task
_CHUNK = re.compile(r"(?= \S)")
_ODD = re.compile(r" (?:\s|$)")


def read_ranks(data: bytes) -> dict[bytes, int]:
    """Tokens and ranks of a file with a base64 token and its rank on each line."""
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in data.splitlines() if line)}


class BytePairCodec:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.pattern = regex.compile(pattern)
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for token, rank in ranks.items():
            self.automaton.add_word(token.decode("latin-1"), rank)
        self.automaton.make_automaton()
        self.length = {rank: len(token) for token, rank in ranks.items()}
        self.bits = max(self.tokens, default=0).bit_length()
        self._pairs: dict[int, bool] = {}
        self._halves: dict[int, tuple[int, int] | None] = {}
        self._shorter: dict[int, int] = {}
        self._chunks: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}

    def merge(self, data: bytes, until: int = 1) -> list[int]:
        """The merges run one by one, lowest rank first, leftmost among equals: the definition.

        Stops early when ``until`` parts are left.
        """
        parts = [data[i : i + 1] for i in range(len(data))]
        ranks = self.ranks
        while len(parts) > until:
            best, at = min((ranks.get(a + b, 1 << 62), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if best == 1 << 62:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [ranks[p] for p in parts]

    def halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes ``token``; None for a single byte."""
        if token not in self._halves:
            data = self.tokens[token]
            parts = self.merge(data, until=2) if len(data) > 1 else None
            self._halves[token] = tuple(parts) if parts and len(parts) == 2 else None
        return self._halves[token]

    def compatible(self, left: int, right: int) -> bool:
        """Whether the merges of the joined bytes leave these two tokens (left -1: the token alone).

        Merges are undone from the last to the first on the two sides of the
        border. At each point the two tokens that meet there must not merge
        before the one undone last was made: lower ranks come first, and of
        equal ranks the one further left.
        """
        key = left << self.bits | right
        known = self._pairs.get(key)
        if known is None:
            if len(self._pairs) >= PAIRS:
                self._pairs.clear()
            known = self.merge(self.tokens[right]) == [right] if left < 0 else self._border(left, right)
            self._pairs[key] = known
        return known

    def _border(self, a: int, b: int) -> bool:
        tokens, ranks = self.tokens, self.ranks
        limit = 1 << 62
        while True:
            joined = ranks.get(tokens[a] + tokens[b])
            if joined is not None and joined < limit:
                return False
            # Made last: the higher rank; of one and the same token on both sides, the right one.
            made_a, made_b = self.halves(a), self.halves(b)
            if made_b and (not made_a or b >= a):
                limit, b = b + 1, made_b[0]
            elif made_a:
                limit, a = a, made_a[1]
            else:
                return True

    def shorter(self, token: int) -> int:
        """The longest token that is a proper prefix of ``token``, or -1."""
        known = self._shorter.get(token)
        if known is None:
            data = self.tokens[token]
            known = next((self.ranks[data[:k]] for k in range(len(data) - 1, 0, -1) if data[:k] in self.ranks), -1)
            self._shorter[token] = known
        return known

    def encode_piece(self, data: bytes) -> list[int]:
        """Ids of one match of the pattern."""
        whole = self.ranks.get(data)
        if whole is not None and self.compatible(-1, whole):
            return [whole]
        n = len(data)
        length = self.length
        longest = [-1] * n
        for end, token in self.automaton.iter(data.decode("latin-1")):
            longest[end - length[token] + 1] = token  # later ends are longer
        pairs, bits, compatible = self._pairs, self.bits, self.compatible
        out: list[int] = []
        dead: set[int] = set()
        pos, token, last = 0, longest[0], -1
        while pos < n:
            while token >= 0:
                end = pos + length[token]
                if end not in dead:
                    fits = pairs.get(last << bits | token)
                    if fits or fits is None and compatible(last, token):
                        break
                token = self.shorter(token)
            if token >= 0:
                out.append(token)
                pos, last = end, token
                token = longest[pos] if pos < n else -1
            else:
                if not out:
                    raise ValueError("a byte of the text is no token of the vocabulary")
                dead.add(pos)
                token = out.pop()
                pos -= length[token]
                last = out[-1] if out else -1
        return out

    def _ids(self, chunk: str) -> bytes:
        """Ids of a chunk or a piece, through the memo."""
        ids = self._chunks.get(chunk)
        if ids is not None:
            return ids
        ids = self._older.get(chunk)
        if ids is None:
            pieces = self.pattern.findall(chunk)
            if len(pieces) == 1:
                ids = np.array(self.encode_piece(chunk.encode()), dtype="<u4").tobytes()
            else:
                ids = b"".join(map(self._ids, pieces))
        if len(chunk) <= 64:
            if len(self._chunks) >= CHUNKS:
                self._older, self._chunks = self._chunks, {}
            self._chunks[chunk] = ids
        return ids

    def encode(self, text: str) -> np.ndarray:
        """Ids of a whole text (unsigned 32-bit)."""
        if _ODD.search(text):
            chunks = _CHUNK.split(text)
        else:
            first, *rest = text.split(" ")
            chunks = [first, *[" " + c for c in rest]]
        known = self._chunks.get
        parts = list(map(known, chunks))
        if None in parts:
            parts = [self._ids(c) if p is None else p for c, p in zip(chunks, parts)]
        return np.frombuffer(b"".join(parts), dtype="<u4")

    def decode(self, ids) -> bytes:
        tokens = self.tokens
        return b"".join([tokens[i] for i in np.asarray(ids).tolist()])


@lru_cache(maxsize=2)
def _codec(data: bytes, pattern: str) -> BytePairCodec:
    """One codec for each Python worker and vocabulary."""
    return BytePairCodec(read_ranks(data), pattern)


def default_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def codec(ranks_path: str | None = None, pattern: str | None = None) -> BytePairCodec:
    return _codec(tokenizer_bytes(ranks_path or tokenizer_path("byte_bpe_50k.tiktoken")), pattern or default_pattern())


def _vocabulary(docs: DataFrame, path: str | None) -> Broadcast:
    """The rank file (about 1 MB, whatever the size of the input), sent to the executors."""
    return docs.sparkSession.sparkContext.broadcast(tokenizer_bytes(path or tokenizer_path("byte_bpe_50k.tiktoken")))


def encode_documents(docs: DataFrame, ranks_path: str | None = None, pattern: str | None = None) -> DataFrame:
    """doc_id and ids (array<bigint>) of every row, without special tokens.

    Null and empty texts give no ids. Rows are independent: repeated doc_ids
    and null doc_ids are rows like any other, other columns are not read.
    """
    data, pattern = _vocabulary(docs, ranks_path), pattern or default_pattern()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _codec(data.value, pattern)
        for batch in slices(batches, "text"):
            ids = pa.array([bpe.encode(t).astype(np.int64) for t in texts_of(batch)], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([column(batch, "doc_id"), ids], ["doc_id", "ids"])

    return to_python(docs.select("doc_id", "text")).mapInArrow(run, "doc_id bigint, ids array<bigint>")


def decode_documents(encoded: DataFrame, ranks_path: str | None = None, pattern: str | None = None) -> DataFrame:
    """doc_id and data (the bytes of the ids) of every row; null ids give no bytes."""
    data, pattern = _vocabulary(encoded, ranks_path), pattern or default_pattern()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _codec(data.value, pattern)
        for batch in batches:
            out = [bpe.decode(ids or []) for ids in column(batch, "ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([column(batch, "doc_id"), pa.array(out, pa.binary())], ["doc_id", "data"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, data binary")


DIGESTS = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"


def encode_and_decode(docs: DataFrame, ranks_path: str | None = None, pattern: str | None = None) -> DataFrame:
    """Digests of every row's ids (little-endian unsigned 32-bit) and of the bytes decoded from them.

    The ids stay in the task: a table of ids would be larger than the texts. Null and empty texts have no
    ids; a text of any length is encoded whole. Rows are independent, so repeated rows and ids have equal
    results; an empty table gives none. Columns other than doc_id and text are not read.
    """
    data, pattern = _vocabulary(docs, ranks_path), pattern or default_pattern()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _codec(data.value, pattern)
        schema = arrow_schema(DIGESTS)
        for batch in slices(batches, "text"):
            each = [bpe.encode(t) for t in texts_of(batch)]
            yield pa.RecordBatch.from_arrays(
                [
                    column(batch, "doc_id").cast(pa.int64()),
                    pa.array([len(i) for i in each], pa.int64()),
                    pa.array([hashlib.sha256(i.tobytes()).hexdigest() for i in each], pa.string()),
                    pa.array([hashlib.sha256(bpe.decode(i)).hexdigest() for i in each], pa.string()),
                ],
                schema=schema,
            )

    return to_python(docs.select("doc_id", "text")).mapInArrow(run, DIGESTS)
