"""Benchmark decontamination with a generalised suffix automaton (13).

The test items, lower-cased and cut into words, make one automaton that knows
every sequence of words that occurs in an item. A document's words are streamed
through it: after each word the state and the longest match that ends there are
known, so every occurrence of a window (``window`` consecutive words of an item,
or a shorter item as a whole) is seen in one pass, whatever the number of items.
A state says which items hold its window.

The automaton holds at most BLOCK_WORDS words of items: a larger set of items
makes several, each broadcast and streamed through in a pass of its own, whose
finds (rows with a match only) are written and put together by the digest of
the text. A long item is cut into parts that overlap by ``window`` - 1 words, so
no window is lost. Documents are not shuffled while one automaton holds all.

Defined results: null and empty texts have no words and no hits; an item without
words never occurs. Equal documents are rows of their own. An item id that
repeats counts once, a null one as an empty string. Without items nothing is
hit; an empty table gives no rows. Other columns are kept by ``clean_documents``
and not read by ``overlap_report``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from datescore.llm.common import column, free_name, release, slices, texts_of, to_python, written

WINDOW = 10
BLOCK_WORDS = 100_000  # words of items in one automaton

# Words are digits, letters a to z and all that is not ASCII; any other byte becomes a space.
_TABLE = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)).lower()
_WORD = re.compile(rb"[^ ]+")


def normalised(text: str | None) -> bytes:
    """The text's bytes, lower-cased (A to Z only), with a space for each byte outside words."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_TABLE)


class Automaton:
    """Suffix automaton of several word sequences; each has the ids of the items it came from."""

    def __init__(self, sequences: list[tuple[tuple[bytes, ...], bool, list[str]]], window: int = WINDOW):
        """``sequences``: (words, whether they are a whole item, item ids)."""
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.length, self.link = [0], [-1]
        self.moves: list[dict[int, int]] = [{}]
        coded = [[self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words] for words, _, _ in sequences]
        for words in coded:
            last = 0
            for w in words:
                last = self._extend(last, w)
        #: ids of the items that hold the window of a state; short items (length, ids) that end there.
        self.holders: dict[int, set[str]] = {}
        self.short: dict[int, list[tuple[int, set[str]]]] = {}
        for words, (_, whole, ids) in zip(coded, sequences):
            state = 0
            for k, w in enumerate(words):
                state = self.moves[state][w]
                if k + 1 >= window:
                    self.holders.setdefault(self._of_length(state, window), set()).update(ids)
            if whole and 0 < len(words) < window:
                self.short.setdefault(self._of_length(state, len(words)), []).append((len(words), set(ids)))
        self._inherit()

    def _extend(self, last: int, w: int) -> int:
        moves, length, link = self.moves, self.length, self.link
        known = moves[last].get(w)
        if known is not None:
            return known if length[known] == length[last] + 1 else self._split(last, w, known)
        new = self._state(length[last] + 1, {})
        p = last
        while p >= 0 and w not in moves[p]:
            moves[p][w] = new
            p = link[p]
        if p < 0:
            link[new] = 0
        else:
            q = moves[p][w]
            link[new] = q if length[q] == length[p] + 1 else self._split(p, w, q)
        return new

    def _state(self, length: int, moves: dict[int, int]) -> int:
        self.length.append(length)
        self.link.append(0)
        self.moves.append(moves)
        return len(self.length) - 1

    def _split(self, p: int, w: int, q: int) -> int:
        """A state of its own for the shorter sequences of ``q`` that are reached from ``p``."""
        clone = self._state(self.length[p] + 1, dict(self.moves[q]))
        self.link[clone], self.link[q] = self.link[q], clone
        while p >= 0 and self.moves[p].get(w) == q:
            self.moves[p][w] = clone
            p = self.link[p]
        return clone

    def _of_length(self, state: int, n: int) -> int:
        """The state of the last ``n`` words of a sequence that ends in ``state``."""
        while self.length[self.link[state]] >= n:
            state = self.link[state]
        return state

    def _inherit(self) -> None:
        """Each state learns its window's state and the short items among its suffixes."""
        order = sorted(range(1, len(self.length)), key=self.length.__getitem__)
        self.window_of = [0] * len(self.length)
        for v in order:
            up = self.link[v]
            if self.length[v] >= self.window:
                self.window_of[v] = self.window_of[up] if self.length[up] >= self.window else v
            if up in self.short:
                self.short[v] = self.short.get(v, []) + self.short[up]

    def spans(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Stretches of hit words (start, end), merged, and the ids of the items whose windows occur."""
        moves, link, length, short, window = self.moves, self.link, self.length, self.short, self.window
        found: list[list[int]] = []
        states, items = set(), set()
        v = n = 0

        def add(start: int, end: int) -> None:
            while found and found[-1][1] >= start:
                start = min(start, found.pop()[0])
            found.append([start, end])

        for k, w in enumerate(map(self.vocabulary.get, words), 1):
            if w is None:
                v = n = 0
                continue
            to = moves[v].get(w)
            while to is None:  # every word known has a move from the root
                v = link[v]
                n = length[v]
                to = moves[v].get(w)
            v, n = to, n + 1
            if n >= window:
                add(k - window, k)
                states.add(self.window_of[v])
            if v in short:
                for size, ids in short[v]:
                    if size <= n:
                        add(k - size, k)
                        items |= ids
        for s in states:
            items |= self.holders[s]
        return [(a, b) for a, b in found], items


def automata(items: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> Iterator[Automaton]:
    """The items' automata, one after the other, each over at most ``block_words`` words (and one part)."""
    held: dict[tuple[tuple[bytes, ...], bool], list[str]] = {}
    size, step = 0, max(block_words, window)
    rows = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), "text")
    for r in rows.toLocalIterator():
        words = normalised(r.text).split()
        for start in range(0, max(len(words) - window, 0) + 1, step):
            part = tuple(words[start : start + step + window - 1])
            if not part:
                continue
            if size and size + len(part) > block_words and (part, len(words) < window) not in held:
                yield Automaton([(*key, ids) for key, ids in held.items()], window)
                held, size = {}, 0
            key = (part, len(words) < window)
            if key not in held:
                size += len(part)
            held.setdefault(key, []).append(r.item)
    if held:
        yield Automaton([(*key, ids) for key, ids in held.items()], window)


def _scan(docs: DataFrame, shared: Broadcast | None, keep: list[str], names: list[str], only_found: bool = False) -> DataFrame:
    """The ``keep`` columns of ``docs`` with (number of words, spans as start, end, ..., items)."""
    schema = T.StructType(
        [docs.schema[c] for c in keep]
        + [T.StructField(n, t) for n, t in zip(names, (T.LongType(), T.ArrayType(T.IntegerType()), T.ArrayType(T.StringType())))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = shared.value if shared is not None else None
        for batch in slices(batches, "text"):
            counts, spans, items = [], [], []
            for text in texts_of(batch):
                words = normalised(text).split()
                some, ids = automaton.spans(words) if automaton is not None else ([], ())
                counts.append(len(words))
                spans.append([x for span in some for x in span])
                items.append(sorted(ids))
            added = [pa.array(counts, pa.int64()), pa.array(spans, pa.list_(pa.int32())), pa.array(items, pa.list_(pa.string()))]
            out = pa.RecordBatch.from_arrays([*(column(batch, c) for c in keep), *added], names=schema.names)
            yield out.filter(pa.array([bool(s) for s in spans])) if only_found else out
        release()

    return to_python(docs).mapInArrow(run, schema)


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans of several automata, put together so that none overlap."""
    for batch in batches:
        merged = []
        for flat in column(batch, "spans").to_pylist():
            out: list[int] = []
            for start, end in sorted(zip(flat[::2], flat[1::2])):
                if out and out[-1] >= start:
                    out[-1] = max(out[-1], end)
                else:
                    out += [start, end]
            merged.append(out)
        at = batch.schema.get_field_index("spans")
        yield batch.set_column(at, batch.schema.field(at), pa.array(merged, pa.list_(pa.int32())))


def with_overlaps(
    docs: DataFrame, items: DataFrame, keep: list[str], names: list[str], window: int = WINDOW, block_words: int = BLOCK_WORDS
) -> DataFrame:
    """The ``keep`` columns of every document, with three more called ``names``.

    They are the number of words, the hit words' stretches (flat: start, end, ...) and the items' ids in order.
    """
    context = docs.sparkSession.sparkContext
    every = automata(items, window, block_words)
    first, second = next(every, None), next(every, None)
    if second is None:
        return _scan(docs, context.broadcast(first) if first else None, keep, names)
    key = free_name(docs, "text_key")
    keyed = docs.withColumn(key, F.sha2(F.coalesce("text", F.lit("")), 256))
    parts, automaton = None, first
    while automaton is not None:
        shared = context.broadcast(automaton)
        part = _scan(keyed.select(key, "text"), shared, [key], ["n", "spans", "items"], only_found=True)
        part = written(part.withColumnRenamed(key, "k"), "overlaps")
        parts = part if parts is None else parts.unionByName(part)
        shared.destroy()
        automaton, second = second, next(every, None)
    # Equal texts have equal finds in each part: sets hold one array for each automaton at most.
    found = (
        parts.groupBy("k")
        .agg(F.flatten(F.collect_set("spans")).alias("spans"), F.flatten(F.collect_set("items")).alias("items"))
        .withColumn("items", F.array_sort(F.array_distinct("items")))
    )
    found = found.mapInArrow(_merge, found.schema).select(F.col("k").alias(key), *[F.col(c).alias(n) for c, n in zip(("spans", "items"), names[1:])])
    counted = _scan(keyed, None, [*keep, key], names).drop(*names[1:])
    whole = counted.join(found, key, "left")
    none = (F.array().cast("array<int>"), F.array().cast("array<string>"))
    return whole.select(*keep, names[0], *[F.coalesce(n, e).alias(n) for n, e in zip(names[1:], none)])


def n_hit(spans: str) -> F.Column:
    """Words inside the flat spans: ends less starts."""
    signed = F.transform(F.col(spans), lambda x, i: F.when(i % 2 == 1, x).otherwise(-x).cast("bigint"))
    return F.aggregate(signed, F.lit(0).cast("bigint"), lambda a, x: a + x)


def overlap_report(docs: DataFrame, items: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Per document: its words, hit words, the items that occur in it and their digest."""
    names = ["n_words", "spans", "items"]
    found = with_overlaps(docs.select("doc_id", "text"), items, ["doc_id"], names, window, block_words)
    hit = n_hit("spans")
    return found.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


def cut(text: str, spans: list[int]) -> str:
    """``text`` without the words of the spans and what stands between them."""
    data = text.encode("utf-8", "surrogatepass")
    words = [m.span() for m in _WORD.finditer(normalised(text))]
    out, at = [], 0
    for start, end in zip(spans[::2], spans[1::2]):
        out.append(data[at : words[start][0]])
        at = words[end - 1][1]
    out.append(data[at:])
    return b"".join(out).decode("utf-8", "surrogatepass")


def clean_documents(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, max_coverage: float = 0.5, block_words: int = BLOCK_WORDS
) -> DataFrame:
    """All columns of ``docs``; hit stretches are cut from the texts.

    A stretch goes if it is ``window`` words or more, or covers a whole shorter
    item. A document goes if more than ``max_coverage`` of its words are hit.
    """
    names = [free_name(docs, n) for n in ("n_words", "spans", "items")]
    found = with_overlaps(docs, items, docs.columns, names, window, block_words)
    left = found.where(n_hit(names[1]) <= F.lit(max_coverage) * F.col(names[0])).drop(names[0], names[2])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            spans = column(batch, names[1]).to_pylist()
            texts = [cut(t, s) if s else t for t, s in zip(column(batch, "text").to_pylist(), spans)]
            at = batch.schema.get_field_index("text")
            out = batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))
            yield out.drop_columns([names[1]])
        release()

    return to_python(left).mapInArrow(run, docs.schema)


REPORT_SQL = r"""
WITH w AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
i AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
g AS MATERIALIZED (
  SELECT DISTINCT item_id, n, array_to_string(w[k + 1 : k + n], ' ') AS g
  FROM (SELECT item_id, w, least(len(w), 10) AS n, unnest(range(greatest(len(w) - 9, 1))) AS k FROM i WHERE len(w) > 0)),
d AS (
  SELECT rid, n, k, array_to_string(w[k + 1 : k + n], ' ') AS g
  FROM (SELECT rid, w, n, unnest(range(len(w) - n + 1)) AS k FROM w, (SELECT DISTINCT n FROM g) WHERE len(w) >= n)),
m AS MATERIALIZED (SELECT rid, d.n, k, item_id FROM d JOIN g USING (n, g)),
h AS (SELECT rid, count(*) AS n_hit FROM (SELECT DISTINCT rid, unnest(range(k, k + n)) AS p FROM m) GROUP BY rid),
s AS (
  SELECT rid, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT rid, item_id FROM m) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN h USING (rid) LEFT JOIN s USING (rid)
"""
