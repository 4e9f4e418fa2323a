"""LM scoring (4): prediction by partial matching over bytes, beside a unigram base score.

The model is a trie of byte contexts up to ORDER bytes. A byte is predicted by
the longest context seen in training; if it was never seen there, an escape
(method C: as likely as the number of distinct bytes of the context) leads to the
next shorter context, in which the bytes already ruled out are excluded. Below
order 0 the remaining bytes are equally likely. 0xFF, which UTF-8 never
uses, stands ORDER times before a text and once after it as its end. A
text's score is the log10 probability of its bytes (A-Z lower-cased) and end.

Pretrained (the default): counts of all training texts, each level a sorted table of
(context, byte) with its log probability, applied to whole slices of
text at once. ``PpmTrie`` is the same model one byte at a time; it also scores
adaptively, learning each byte after coding it.

At scale: one scan counts words and context grams (both summed in the task
before the shuffle), a second scores. The order is the same at every size. A trie
of at most MAX_NODES nodes is broadcast; of a larger one only the most
frequent grams are, with their probabilities, and the other grams of a document
are joined by shuffle (each distinct one looked up once, in tables of the longer
contexts; the orders of at most MAX_NODES / 4 nodes, at least order 1 with its
2^16, are broadcast). Word counts grow with the input and are never
broadcast whole: the FREQUENT most frequent words are (a fixed number), the
other words of a document are joined by shuffle.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from datescore.llm.common import arrow_schema, column, slices, to_python, written

ORDER = 5
MAX_NODES = 1 << 22
FREQUENT = 200_000
BLOCK = 1 << 16
FLUSH = 400_000  # entries a task holds before it emits its partial counts
END = b"\xff"
END_WORD = b"\xff"  # the end token; no word of a text can be this byte
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def lowered(text: str | None) -> bytes:
    return (text or "").encode().translate(_LOWER)


def words(data: bytes) -> list[bytes]:
    """Runs without white space (bytes 0x20 and 0x09 to 0x0D), then the end token."""
    return data.split() + [END_WORD]


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows the model does not learn from; a null doc_id counts as empty text (not held out)."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 7 == 2


# --- grams -----------------------------------------------------------------------------


def grams(texts: list[bytes], order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """Keys (context and byte, ``order`` + 1 bytes) of all positions, and the positions of each text."""
    pad = END * order
    data = b"".join([pad + t + END for t in texts])
    lengths = np.array([len(t) + 1 for t in texts], dtype=np.int64)
    n = len(data) - order
    # Eight bytes read at every position, big-endian, of which the first order + 1 are kept.
    every = np.ndarray((n,), dtype=">u8", buffer=data + bytes(8), strides=(1,))
    key = every.astype(np.uint64) >> np.uint64(8 * (7 - order))
    # Of text i, the symbols begin at the sum of the lengths before it plus the pads up to it.
    keep = np.ones(n, dtype=bool)
    starts = np.cumsum(lengths) - lengths + order * np.arange(len(texts))
    for k in range(1, order + 1):
        keep[(starts - k)[starts >= k]] = False
    return key[keep], lengths


def add_counts(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, with the sums of their counts."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """The counts of several parts as one."""
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return add_counts(np.concatenate([k for k, _ in parts]), np.concatenate([c for _, c in parts]))


class _Table:
    """Open-addressing table from 64-bit keys to their rank in the sorted key array."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        self._build()

    def __getstate__(self):
        return self.keys  # sent without the slots, which each worker builds

    def __setstate__(self, keys: np.ndarray):
        self.keys = keys
        self._build()

    def _build(self) -> None:
        keys, size = self.keys, 64
        while size < 1.5 * len(keys):
            size *= 2
        self.shift = np.uint64(64 - size.bit_length() + 1)
        self.mask = size - 1
        self.rank = np.full(size, -1, dtype=np.int32)
        todo = np.arange(len(keys), dtype=np.int32)
        slot = self._slot(keys)
        while len(todo):
            free = self.rank[slot] < 0
            _, first = np.unique(slot[free], return_index=True)
            put = np.flatnonzero(free)[first]
            self.rank[slot[put]] = todo[put]
            rest = np.ones(len(todo), dtype=bool)
            rest[put] = False
            todo, slot = todo[rest], (slot[rest] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).view(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Rank of each key, -1 where it is absent."""
        if not len(self.keys):
            return np.full(len(keys), -1, dtype=np.int32)
        slot = self._slot(keys)
        out = self.rank[slot]
        on = np.flatnonzero((self.keys[out] != keys) & (out >= 0))
        while len(on):
            slot[on] = (slot[on] + 1) & self.mask
            rank = self.rank[slot[on]]
            out[on] = rank
            on = on[(rank >= 0) & (self.keys[rank] != keys[on])]
        return np.where(self.keys[out] == keys, out, np.int32(-1))


class _Values(_Table):
    """Open-addressing table from 64-bit keys to values, both kept in the slots: two reads a lookup."""

    EMPTY = ~np.uint64(0)  # no gram of up to seven bytes

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.values = values
        super().__init__(keys)

    def __getstate__(self):
        return self.keys, self.values

    def __setstate__(self, state: tuple):
        self.keys, self.values = state
        self._build()

    def _build(self) -> None:
        super()._build()
        full = self.rank >= 0
        self.slot_keys = np.where(full, self.keys[self.rank], self.EMPTY) if len(self.keys) else np.full(len(full), self.EMPTY)
        self.slot_values = np.where(full, self.values[self.rank], 0.0) if len(self.keys) else np.zeros(len(full))
        del self.rank

    def get(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values of the keys, and the positions of those that are absent (whose values mean nothing)."""
        slot = self._slot(keys)
        held = self.slot_keys.take(slot, mode="clip")
        out = self.slot_values.take(slot, mode="clip")
        absent = []
        on = np.flatnonzero(held != keys)
        while len(on):
            empty = held[on] == self.EMPTY
            absent.append(on[empty])
            on = on[~empty]
            slot[on] = (slot[on] + 1) & self.mask
            held[on] = self.slot_keys[slot[on]]
            found = held[on] == keys[on]
            out[on[found]] = self.slot_values[slot[on[found]]]
            on = on[~found]
        return out, np.concatenate(absent) if absent else on


class PpmModel:
    """The pretrained trie as arrays, from the counts of its longest grams."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, order: int = ORDER, below: bool = False):
        """``below``: the model stands below longer contexts, and ``escaped`` also finds its longest grams."""
        self.order, self.below = order, below
        keys, counts = add_counts(keys.astype(np.uint64), counts.astype(np.int64))
        self.levels = []  # from order 0 up: grams, log counts, contexts and their logs
        for j in range(order + 1):
            mask = np.uint64((1 << (8 * (j + 1))) - 1)
            g, c = add_counts(keys & mask, counts)
            ctx = g >> np.uint64(8) if j else np.zeros(len(g), dtype=np.uint64)
            first = np.flatnonzero(np.concatenate([[True], ctx[1:] != ctx[:-1]])) if len(g) else np.zeros(0, np.int64)
            total = np.add.reduceat(c, first) if len(first) else c
            distinct = np.diff(np.concatenate([first, [len(g)]]))
            level = {"grams": _Table(g), "count": c, "of": np.repeat(np.arange(len(first), dtype=np.int32), distinct)}
            level |= {"contexts": _Table(ctx[first]), "total": total, "distinct": distinct}
            if j and len(g):
                # Below this context, with its bytes excluded: what is left in the next shorter one.
                lower = self.levels[j - 1]
                short = lower["contexts"].find(ctx[first] & np.uint64((1 << (8 * (j - 1))) - 1))
                gone = np.add.reduceat(lower["count"][lower["grams"].find(g & (mask >> np.uint64(8)))], first)
                fresh = lower["distinct"][short] - distinct
                level["rest"] = lower["total"][short] - gone + fresh
                level["fresh"] = fresh
            self.levels.append(level)
        self.distinct = len(self.levels[0]["grams"].keys)  # bytes seen at all
        longest = self.levels[-1]
        size = longest["total"] + longest["distinct"]
        top = np.log10(longest["count"] / size[longest["of"]]) if len(counts) else np.zeros(0)
        # Grams of the longest contexts are looked up in ``top`` alone.
        self.top = _Values(longest["grams"].keys, top)
        if not below:
            longest["grams"] = longest["count"] = longest["of"] = None

    @property
    def nodes(self) -> int:
        return len(self.top.keys)

    def log10(self, keys: np.ndarray) -> np.ndarray:
        """log10 probability of the last byte of each gram after the bytes before it."""
        out = np.full(len(keys), -math.log10(256))
        if self.nodes:
            for start in range(0, len(keys), BLOCK):  # blocks that stay in the processor's cache
                block = keys[start : start + BLOCK]
                here, absent = self.top.get(block)
                here[absent] = self.escaped(block[absent])
                out[start : start + BLOCK] = here
        return out

    def escaped(self, keys: np.ndarray, rest: np.ndarray | None = None, fresh: np.ndarray | None = None) -> np.ndarray:
        """The same for grams that the longest context has not seen.

        ``rest`` and ``fresh`` are what a longer known context leaves in its next shorter one (-1: there is none).
        """
        out = np.zeros(len(keys))
        todo = np.arange(len(keys))
        rest = np.full(len(keys), -1, dtype=np.int64) if rest is None else rest.copy()
        fresh = np.full(len(keys), -1, dtype=np.int64) if fresh is None else fresh.copy()
        for j in range(self.order, -1, -1):
            level = self.levels[j]
            g = keys[todo] & np.uint64((1 << (8 * (j + 1))) - 1)
            # The caller has not found these grams at the longest contexts, unless those stand below others.
            rank = level["grams"].find(g) if j < self.order or self.below else np.full(len(g), -1)
            hit = rank >= 0
            ctx = np.full(len(g), -1, dtype=np.int64)
            if hit.any():
                ctx[hit] = level["of"][rank[hit]]
            miss = np.flatnonzero(~hit)
            ctx[miss] = level["contexts"].find(g[miss] >> np.uint64(8) if j else np.zeros(len(miss), dtype=np.uint64))
            known = ctx >= 0
            size, escape = rest[todo].astype(float), fresh[todo].astype(float)
            none = size < 0  # no exclusion: the longest known context starts here
            size[none] = escape[none] = 0
            a = known & none
            size[a] = level["total"][ctx[a]] + level["distinct"][ctx[a]]
            escape[a] = level["distinct"][ctx[a]]
            if hit.any():
                out[todo[hit]] += np.log10(level["count"][rank[hit]] / size[hit])
            lost = ~hit & (size > 0)
            out[todo[lost]] += np.log10(escape[lost] / size[lost])
            if j and known.any():
                rest[todo[known]], fresh[todo[known]] = level["rest"][ctx[known]], level["fresh"][ctx[known]]
            todo = todo[~hit]
        out[todo] -= math.log10(256 - self.distinct)
        return out

    def score(self, texts: list[bytes]) -> np.ndarray:
        keys, lengths = grams(texts, self.order)
        return np.add.reduceat(self.log10(keys), np.cumsum(lengths) - lengths) if len(texts) else np.zeros(0)

    def known_and_rare(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Scores of the texts, and no grams left to look up (see ``FrequentGrams``)."""
        none = np.zeros(0, np.int64)
        return self.score(texts), none, none, none


class FrequentGrams:
    """log10 probabilities of the most frequent grams of a trie too large to be broadcast."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, order: int):
        self.table, self.order = _Values(keys, values), order

    def known_and_rare(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Sums over the grams held, and of the others the text (ascending), the gram and how often it stands there."""
        keys, lengths = grams(texts, self.order)
        values, missing = np.zeros(len(keys)), []
        for start in range(0, len(keys), BLOCK):
            here, absent = self.table.get(keys[start : start + BLOCK])
            here[absent] = 0.0
            values[start : start + BLOCK] = here
            missing.append(absent + start)
        missing = np.concatenate(missing)
        sums = np.add.reduceat(values, np.cumsum(lengths) - lengths)
        text = np.repeat(np.arange(len(texts)), lengths)[missing]
        rare = keys[missing]
        order = np.lexsort((rare, text))
        text, rare = text[order], rare[order]
        first = np.flatnonzero(np.concatenate([[True], (text[1:] != text[:-1]) | (rare[1:] != rare[:-1])])) if len(rare) else missing
        return sums, text[first], rare[first].view(np.int64), np.diff(np.concatenate([first, [len(rare)]]))


class PpmTrie:
    """The same model byte by byte, from nested counts; adaptive when it learns from what it codes."""

    def __init__(self, order: int = ORDER):
        self.order = order
        self.counts: dict[bytes, Counter] = {}

    def learn(self, text: bytes) -> PpmTrie:
        for context, byte in self._symbols(text):
            self._add(context, byte)
        return self

    def _symbols(self, text: bytes):
        data = END * self.order + text + END
        for i in range(self.order, len(data)):
            yield data[i - self.order : i], data[i]

    def _add(self, context: bytes, byte: int) -> None:
        for j in range(self.order + 1):
            self.counts.setdefault(context[j:], Counter())[byte] += 1

    def probability(self, context: bytes, byte: int) -> float:
        p, excluded = 1.0, set()
        for j in range(self.order + 1):
            seen = self.counts.get(context[j:])
            if not seen:
                continue
            left = {b: c for b, c in seen.items() if b not in excluded}
            size = sum(left.values()) + len(left)
            if byte in left:
                return p * left[byte] / size
            if size:
                p *= len(left) / size
            excluded |= seen.keys()
        return p / (256 - len(excluded))

    def log10(self, text: bytes, adaptive: bool = False) -> float:
        total = 0.0
        for context, byte in self._symbols(text):
            total += math.log10(self.probability(context, byte))
            if adaptive:
                self._add(context, byte)
        return total


# --- counting and scoring ---------------------------------------------------------------

COUNTS = "word binary, gram bigint, n bigint"


def corpus_counts(texts: DataFrame, order: int = ORDER) -> DataFrame:
    """Counts of all words (gram null) and all byte grams (word null) of the column ``text``."""
    if not 1 <= order <= 6:
        raise ValueError("a gram of order + 1 bytes is kept in 64 bits: the order is 1 to 6")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema(COUNTS)

        def out(found: Counter, keys: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
            w, g = len(found), len(keys)
            if w:
                arrays = [pa.array(list(found), pa.binary()), pa.nulls(w, pa.int64()), pa.array(list(found.values()), pa.int64())]
                yield pa.RecordBatch.from_arrays(arrays, schema=schema)
            if g:
                arrays = [pa.nulls(g, pa.binary()), pa.array(keys.view(np.int64)), pa.array(counts.astype(np.int64))]
                yield pa.RecordBatch.from_arrays(arrays, schema=schema)

        found: Counter = Counter()
        parts, held = [], 0  # counted grams of several slices, merged when there are many
        for batch in slices(batches, "text"):
            texts = [lowered(t) for t in column(batch, "text").to_pylist()]
            for t in texts:
                found.update(words(t))
            parts.append(np.unique(grams(texts, order)[0], return_counts=True))
            held += len(parts[-1][0])
            if held > 2 * FLUSH:
                parts = [merged(parts)]
                if len(found) > FLUSH or len(parts[0][0]) > FLUSH:
                    yield from out(found, *parts[0])
                    found, parts = Counter(), []
                held = sum(len(p[0]) for p in parts)
        yield from out(found, *merged(parts))

    return to_python(texts.select("text")).mapInArrow(run, COUNTS).groupBy("word", "gram").agg(F.sum("n").alias("n"))


def _mask(order: int) -> int:
    """The bits of a gram of ``order`` + 1 bytes."""
    return (1 << (8 * (order + 1))) - 1


def _shorter(table: DataFrame, order: int) -> DataFrame:
    """Counts of the grams of ``order`` from those of a longer one."""
    return table.groupBy(F.col("gram").bitwiseAND(_mask(order)).alias("gram")).agg(F.sum("n").alias("n"))


def ppm_model(counts: DataFrame, order: int = ORDER, below: bool = False) -> PpmModel:
    """The trie from the counted grams, all of them: the caller knows that they are few enough to broadcast."""
    rows = counts.where("gram IS NOT NULL").select("gram", "n").toArrow()
    return PpmModel(rows["gram"].to_numpy().astype(np.uint64), rows["n"].to_numpy(), order, below)


class GramTables:
    """A trie that may have any number of nodes: its longer contexts as tables, its shorter ones as a model.

    Every probability is that of the full trie; only where it is looked up differs.
    """

    def __init__(self, counts: DataFrame, order: int, max_base: int):
        self.order = order
        self.levels = {order: counts.where("gram IS NOT NULL").select("gram", "n")}
        while order > 1 and self.levels[order].count() > max_base:
            order -= 1
            self.levels[order] = written(_shorter(self.levels[order + 1], order), "lm-grams")
        self.base = ppm_model(self.levels[order], order, below=True)
        self.contexts = {j: self._contexts(j) for j in range(self.order, order, -1)}

    def _contexts(self, j: int) -> DataFrame:
        """Contexts of a level: their counts, and what is left in the next shorter one without their bytes."""
        context = F.shiftright("gram", 8).alias("context")
        lower = self.levels[j - 1]
        count = lower.select(F.col("gram").alias("short"), F.col("n").alias("below"))
        own = self.levels[j].withColumn("short", F.col("gram").bitwiseAND(_mask(j - 1))).join(count, "short")
        own = own.groupBy(context).agg(
            F.sum("n").alias("total"), F.count(F.lit(1)).alias("distinct"), F.sum("below").alias("gone")
        )
        short = lower.groupBy(F.shiftright("gram", 8).alias("short")).agg(F.sum("n").alias("all"), F.count(F.lit(1)).alias("kinds"))
        left = own.withColumn("short", F.col("context").bitwiseAND(_mask(j - 2))).join(short, "short")
        fresh = F.col("kinds") - F.col("distinct")
        left = left.select("context", "total", "distinct", (F.col("all") - F.col("gone") + fresh).alias("rest"), fresh.alias("fresh"))
        return written(left, "lm-contexts")

    def frequent(self, most: int) -> FrequentGrams:
        top = frequent_words(self.levels[self.order], most).withColumn("context", F.shiftright("gram", 8))
        value = F.log10(F.col("n") / (F.col("total") + F.col("distinct"))).alias("value")
        rows = top.join(self.contexts[self.order], "context").select("gram", value).toArrow()
        return FrequentGrams(rows["gram"].to_numpy().astype(np.uint64), rows["value"].to_numpy(), self.order)

    def values(self, asked: DataFrame) -> DataFrame:
        """gram and value (log10 probability) of the distinct grams ``asked``."""
        done = []
        todo = asked.select(
            "gram", F.lit(0.0).alias("value"), F.lit(None).cast("long").alias("rest"), F.lit(None).cast("long").alias("fresh")
        )
        for j in range(self.order, self.base.order, -1):
            count = self.levels[j].withColumnRenamed("gram", "key")
            found = self.contexts[j].withColumnsRenamed({"rest": "rest_below", "fresh": "fresh_below"})
            at = todo.withColumn("key", F.col("gram").bitwiseAND(_mask(j))).withColumn("context", F.shiftright("key", 8))
            at = at.join(count, "key", "left").join(found, "context", "left")
            # Without an exclusion the longest known context starts here.
            size = F.coalesce("rest", F.col("total") + F.col("distinct"))
            escape = F.when(F.col("rest").isNotNull(), F.col("fresh")).otherwise(F.col("distinct"))
            part = F.when(size > 0, F.log10(F.coalesce("n", escape) / size)).otherwise(F.lit(0.0))
            at = at.select(
                "gram",
                F.col("n").isNotNull().alias("seen"),
                (F.col("value") + part).alias("value"),
                F.coalesce("rest_below", "rest").alias("rest"),
                F.coalesce("fresh_below", "fresh").alias("fresh"),
            )
            at = written(at, "lm-asked")
            done.append(at.where("seen").select("gram", "value"))
            todo = at.where("NOT seen").drop("seen")
        shared = asked.sparkSession.sparkContext.broadcast(self.base)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            base = shared.value
            for batch in batches:
                gram, value, rest, fresh = (column(batch, c).to_numpy() for c in ("gram", "value", "rest", "fresh"))
                value = value + base.escaped(gram.astype(np.uint64), rest, fresh)
                yield pa.RecordBatch.from_arrays([pa.array(gram), pa.array(value)], ["gram", "value"])

        left = todo.withColumns({c: F.coalesce(c, F.lit(-1).cast("long")) for c in ("rest", "fresh")})
        out = left.mapInArrow(run, "gram bigint, value double")
        for d in done:
            out = out.unionByName(d)
        return out


def frequent_words(vocabulary: DataFrame, most: int) -> DataFrame:
    """The words above the least count that at most ``most`` words reach.

    The count is found in a histogram of logarithms (at most a thousand rows),
    so no task sorts or gathers the vocabulary.
    """
    size = F.floor(F.log2("n") * 16).cast("int")
    edge, total = None, 0
    for r in sorted(vocabulary.groupBy(size.alias("bin")).count().collect(), reverse=True):
        total += r["count"]
        if total > most:
            break
        edge = r.bin
    return vocabulary.where(size >= edge if edge is not None else F.lit(False))


FIRST = "uid bigint, doc_id bigint, held_out boolean, n_tokens bigint, known bigint, logs double, score double"


def score_documents(
    docs: DataFrame, order: int = ORDER, frequent: int = FREQUENT, max_nodes: int = MAX_NODES
) -> DataFrame:
    """Base and model scores of every row, learnt from the rows that are not held out.

    doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score. Null and empty texts are
    the end alone. Repeated doc_ids are rows like any other, and learnt from as often as they stand.
    With no training rows counts are empty (every token unknown) and bytes are equally likely. An empty table gives an
    empty result; other columns are not read. A trie of more than ``max_nodes`` nodes is not broadcast
    whole; the scores are the same.
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", "text", held_out().alias("held_out"))
    counts = written(corpus_counts(rows.where(~F.col("held_out")), order), "lm-counts")
    vocabulary = counts.where("word IS NOT NULL").select("word", "n")
    total, distinct = vocabulary.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    tables = None
    if order > 1 and counts.where("gram IS NOT NULL").count() > max_nodes:
        tables = GramTables(counts, order, max_nodes // 4)
    model = tables.frequent(max_nodes // 2) if tables else ppm_model(counts, order)
    top = frequent_words(vocabulary, frequent).toArrow()
    shared = spark.sparkContext.broadcast((model, top.combine_chunks()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, top = shared.value
        known = {w: math.log10(n + 1) for w, n in zip(top["word"].to_pylist(), top["n"].to_pylist())}
        rare_type = pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int64())]))
        grams_type = pa.list_(pa.struct([("gram", pa.int64()), ("times", pa.int64())]))
        schema = pa.schema([*arrow_schema(FIRST), ("rare", rare_type), ("grams", grams_type)])
        # Unique in the written table: the partition and a running number.
        uid = TaskContext.get().partitionId() << 33
        for batch in slices(batches, "text"):
            texts = [lowered(t) for t in column(batch, "text").to_pylist()]
            rest, rare_words, rare_counts = [], [], []
            for t in texts:
                tokens = words(t)
                logs = list(map(known.get, tokens))
                found = [x for x in logs if x is not None]
                if len(found) < len(logs):
                    rare = Counter([w for w, x in zip(tokens, logs) if x is None])
                    rare_words += rare
                    rare_counts += rare.values()
                rest.append((len(tokens), len(found), math.fsum(found), len(rare_words)))
            n_tokens, n_known, logs, ends = zip(*rest)
            rare = pa.ListArray.from_arrays(
                pa.array([0, *ends], pa.int32()),
                pa.StructArray.from_arrays([pa.array(rare_words, pa.binary()), pa.array(rare_counts, pa.int64())], ["word", "n"]),
            )
            scores, of, gram, times = model.known_and_rare(texts)
            left = pa.ListArray.from_arrays(
                pa.array(np.searchsorted(of, np.arange(len(texts) + 1)), pa.int32()),
                pa.StructArray.from_arrays([pa.array(gram, pa.int64()), pa.array(times, pa.int64())], ["gram", "times"]),
            )
            values = [
                range(uid, uid + len(texts)),
                column(batch, "doc_id"),
                column(batch, "held_out"),
                n_tokens,
                n_known,
                logs,
                scores,
            ]
            uid += len(texts)
            arrays = [pa.array(v, f.type) for v, f in zip(values, schema)]
            yield pa.RecordBatch.from_arrays([*arrays, rare, left], schema=schema)

    ddl = FIRST + ", rare array<struct<word:binary,n:bigint>>, grams array<struct<gram:bigint,times:bigint>>"
    first = written(to_python(rows).mapInArrow(run, ddl), "lm-scores")
    asked = first.select("uid", F.inline("rare")).withColumnRenamed("n", "times")
    found = asked.join(vocabulary, "word").groupBy("uid").agg(
        F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("more_logs"), F.sum("times").alias("more_known")
    )
    size = math.log10(total + distinct + 1)
    out, score = first.drop("rare", "grams").join(found, "uid", "left"), F.col("score")
    if tables:
        asked = first.select("uid", F.inline("grams"))
        value = tables.values(asked.select("gram").distinct())
        more = asked.join(value, "gram").groupBy("uid").agg(F.sum(F.col("times") * F.col("value")).alias("more_score"))
        out, score = out.join(more, "uid", "left"), score + F.coalesce("more_score", F.lit(0.0))
    return out.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("logs") + F.coalesce("more_logs", F.lit(0.0)) - F.col("n_tokens") * F.lit(size)).alias("base_score"),
        score.alias("score"),
    )


def score_adaptively(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """doc_id and the adaptive code length (log10) of every row: each text by a trie that learns it as it goes.

    Null and empty texts are the end alone. Rows are independent: repeated rows have equal lengths, an empty table gives
    none, other columns are not read. A trie grows with its text (order + 1 entries a byte at most) and goes with it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            scores = [PpmTrie(order).log10(lowered(t), adaptive=True) for t in column(batch, "text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [column(batch, "doc_id"), pa.array(scores, pa.float64())], ["doc_id", "score"]
            )

    return to_python(docs.select("doc_id", "text")).mapInArrow(run, "doc_id bigint, score double")
