"""N-gram Jaccard join (9): rare-first prefix filtering, verified once per pair.

A document is the set of its word n-grams (64-bit hashes). Two documents link
when the Jaccard similarity of their sets reaches num / den.

1. Documents with equal sets are one node; everything below is about nodes.
2. N-grams are ordered rare first, by a table of document frequencies over
   all documents (SLOTS counters, each shared by the n-grams that hash to it:
   any total order is correct, a better one makes shorter lists), then by hash.
3. Of n n-grams, the first n - ceil(t n) + 1 are the prefix: linked nodes share
   one. Nodes are joined on prefix n-grams, under the length filter (sizes within
   t) and the positional filter (what can still be shared after the first
   common n-gram).
4. The suffix filter bounds from below how far two sets differ, from the number
   of their n-grams in each of BINS ranges of hashes; pairs that differ too
   far go before their sets are fetched.
5. Each distinct pair that is left is verified once, on the whole sets.

A group of near copies would make all pairs of its members. So pairs are taken in two
rounds. First every node of a prefix n-gram's list is paired with the list's
hub, the node that holds the n-gram earliest. Links make components; then only
pairs of nodes in different components are taken, under the same filters, less those
already verified. No link between components is lost, and links inside
a component change nothing in the result.

At scale: texts are scanned four times and never shuffled. What is shuffled is prefix
rows (about 1 - t of the n-grams), then lists of at least two nodes, then
the sets of nodes that stand in a pair, found in the scan by a fixed-size bit
map. Long lists are never gathered: counts and hubs are aggregated before the
shuffle and joins split skewed lists. Components are found by alternating large and small stars
over written tables.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from datescore.llm.common import arrow_schema, column, free_name, parallelism, slices, to_python, written

SLOTS = 1 << 20  # counters of the frequency table
SLOT_BLOCK = 1 << 12  # counters in one row of it
MAP_BITS = 23  # of the bit map of nodes in pairs
BINS = 128  # ranges of hashes the suffix filter counts in

_LOWER = np.array([c + 32 if 65 <= c <= 90 else c for c in range(256)], dtype=np.uint8)
_WHITE = np.isin(np.arange(256), [0x20, 9, 10, 11, 12, 13])
_MIX = np.random.Generator(np.random.PCG64(9)).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_STEPS = [np.uint64(s) for s in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]


@lru_cache(maxsize=4)
def _powers(base: int, size: int) -> np.ndarray:
    out = np.full(size, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _power(base: int, n: int) -> np.ndarray:
    return _powers(base, 1 << max(16, (n - 1).bit_length()))[:n]


def _mix(h: np.ndarray) -> np.ndarray:
    for s, step in zip((30, 27), _STEPS):
        h = (h ^ (h >> np.uint64(s))) * step
    return h ^ (h >> np.uint64(31))


def _words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of each word of all texts, and the number of words of each text.

    A word's hash is a polynomial of its bytes, cut out of running sums: no
    loop over words.
    """
    joined = b" ".join(texts) + b" "
    a = _LOWER[np.frombuffer(joined, dtype=np.uint8)]
    white = _WHITE[a]
    edge = np.flatnonzero(np.diff(np.concatenate([[True], white, [True]]).view(np.int8)))
    start, end = edge[0::2], edge[1::2]
    sums = np.zeros(len(a) + 1, dtype=np.uint64)
    np.cumsum(_MIX[a] * _power(_BASE, len(a)), out=sums[1:])
    inverse = _power(pow(_BASE, -1, 1 << 64), len(a))
    h = _mix((sums[end] - sums[start]) * inverse[start] + (end - start).astype(np.uint64))
    ends = np.cumsum([len(t) + 1 for t in texts])
    return h, np.diff(np.searchsorted(start, np.concatenate([[0], ends])))


def shingle_sets(texts: list[bytes], n: int) -> list[np.ndarray]:
    """The sorted distinct n-gram hashes of each text; fewer than n words: the whole sequence as one."""
    h, counts = _words(texts)
    out = []
    rows = len(h) - n + 1
    grams = np.zeros(max(rows, 0), dtype=np.uint64)
    for k in range(n):
        if rows > 0:
            grams = _mix(grams + h[k : k + rows]) if k else _mix(h[:rows] ^ np.uint64(n))
    at = 0
    for count in counts.tolist():
        if count >= n:
            out.append(np.unique(grams[at : at + count - n + 1]))
        elif count:
            short = _mix(h[at : at + 1] ^ np.uint64(count))
            for k in range(1, count):
                short = _mix(short + h[at + k : at + k + 1])
            out.append(short)
        else:
            out.append(np.zeros(0, dtype=np.uint64))
        at += count
    return out


def node_of(grams: np.ndarray) -> int | None:
    """Signed 64-bit number of a set; None for the empty set."""
    if not len(grams):
        return None
    total = int(_mix(grams * _STEPS[0]).sum(dtype=np.uint64)) + len(grams) * _BASE
    return int(_mix(np.array([total & (1 << 64) - 1], dtype=np.uint64)).view(np.int64)[0])


def _sets(batch: pa.RecordBatch, n: int) -> list[np.ndarray]:
    return shingle_sets([(t or "").encode() for t in column(batch, "text").to_pylist()], n)


def _batch(rows: list, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(zip(*rows), schema)], schema=schema)


# --- nodes and frequencies --------------------------------------------------------------

NODES = "doc_id bigint, n_shingles bigint, node bigint, bins binary, block int, counts binary"


def bins_of(grams: np.ndarray) -> bytes:
    """How many of a set's n-grams lie in each range of hashes, at most 255."""
    counts = np.bincount((grams >> np.uint64(64 - BINS.bit_length() + 1)).astype(np.int64), minlength=BINS)
    return np.minimum(counts, 255).astype(np.uint8).tobytes()


def _nodes(docs: DataFrame, n: int) -> DataFrame:
    """A row for each document, and each task's frequency counters in blocks (block not null)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema(NODES)
        counters, seen = np.zeros(SLOTS, dtype=np.int64), set()
        for batch in slices(batches, "text"):
            sets = _sets(batch, n)
            counters += np.bincount(_slot(np.concatenate(sets)), minlength=SLOTS)
            ids = column(batch, "doc_id").to_pylist()
            rows = []
            for i, s in zip(ids, sets):
                node = node_of(s)
                first = node is not None and node not in seen
                seen.add(node)
                rows.append((i, len(s), node, bins_of(s) if first else None, None, None))
            yield _batch(rows, schema)
        rows = []
        for block in range(SLOTS // SLOT_BLOCK):
            part = counters[block * SLOT_BLOCK : (block + 1) * SLOT_BLOCK]
            if part.any():
                rows.append((None, None, None, None, block, part.astype("<i8").tobytes()))
        if rows:
            yield _batch(rows, schema)

    return to_python(docs.select("doc_id", "text")).mapInArrow(run, NODES)


def _slot(grams: np.ndarray) -> np.ndarray:
    return (grams >> np.uint64(64 - SLOTS.bit_length() + 1)).astype(np.int64)


def _frequencies(nodes: DataFrame) -> np.ndarray:
    """The summed counters: SLOTS numbers, whatever the size of the input."""

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, total = None, None
        for pdf in batches:
            for block, counts in zip(pdf["block"], pdf["counts"]):
                part = np.frombuffer(counts, dtype="<i8")
                if block != held:
                    if held is not None:
                        yield pd.DataFrame({"block": [held], "counts": [total.astype("<i8").tobytes()]})
                    held, total = block, part.copy()
                else:
                    total = total + part
        if held is not None:
            yield pd.DataFrame({"block": [held], "counts": [total.astype("<i8").tobytes()]})

    parts = nodes.where("block IS NOT NULL").select("block", "counts")
    dealt = parts.repartition(parallelism(nodes.sparkSession), "block").sortWithinPartitions("block")
    out = np.zeros(SLOTS, dtype=np.int64)
    for row in dealt.mapInPandas(add, "block int, counts binary").collect():  # SLOTS / SLOT_BLOCK rows
        out[row.block * SLOT_BLOCK : (row.block + 1) * SLOT_BLOCK] = np.frombuffer(bytes(row.counts), dtype="<i8")
    return out


# --- prefix lists -------------------------------------------------------------------------

PREFIXES = "gram bigint, node bigint, size int, pos int"


def least_overlap(size, num: int, den: int):
    """ceil(t size): what a set of this size shares at least with any set it links to."""
    return -(-num * size // den)


def _prefixes(docs: DataFrame, n: int, num: int, den: int, frequencies) -> DataFrame:
    """Prefix rows (n-gram, node, size, position), each node once for each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema(PREFIXES)
        rank = frequencies.value
        seen: set[int] = set()
        for batch in slices(batches, "text"):
            grams, nodes, sizes, places = [], [], [], []
            for s in _sets(batch, n):
                node = node_of(s)
                if node is None or node in seen:
                    continue
                seen.add(node)
                size = len(s)
                length = size - least_overlap(size, num, den) + 1
                order = np.argsort(rank[_slot(s)], kind="stable")[:length]  # s is sorted by hash
                grams.append(s[order].view(np.int64))
                nodes.append(node)
                sizes.append(size)
                places.append(length)
            if not grams:
                continue
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate(grams)),
                    pa.array(np.repeat(np.array(nodes, dtype=np.int64), places)),
                    pa.array(np.repeat(np.array(sizes, dtype=np.int32), places)),
                    pa.array(np.concatenate([np.arange(p, dtype=np.int32) for p in places])),
                ],
                schema=schema,
            )

    return to_python(docs.select("text")).mapInArrow(run, PREFIXES)


def _may_link(size: Column, pos: Column, size2: Column, pos2: Column, num: int, den: int) -> Column:
    """Length and positional filter of two nodes whose first common n-gram stands at these positions."""
    small, large = F.least(size, size2), F.greatest(size, size2)
    both = size.cast("long") + size2
    return (small * den >= large * num) & (F.least(size - pos, size2 - pos2) * (num + den) >= both * num)


def _lists(prefixes: DataFrame) -> DataFrame:
    """Rows of n-grams that at least two nodes hold, with the hub of each list."""
    ends = prefixes.groupBy("gram").agg(F.min("node").alias("lo"), F.max("node").alias("hi"))
    shared = written(prefixes.join(ends.where("lo <> hi").select("gram"), "gram"), "join-shared")
    hubs = shared.groupBy("gram").agg(F.min(F.struct("pos", "size", "node")).alias("hub"))
    return shared.join(hubs, "gram")


def _ordered(a: Column, b: Column) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _hub_pairs(lists: DataFrame, num: int, den: int) -> DataFrame:
    may = _may_link(F.col("size"), F.col("pos"), F.col("hub.size"), F.col("hub.pos"), num, den)
    return lists.where((F.col("node") != F.col("hub.node")) & may).select(*_ordered(F.col("node"), F.col("hub.node"))).distinct()


def _cross_pairs(lists: DataFrame, roots: DataFrame, done: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs of nodes in different components that share a prefix n-gram, less those verified."""
    rows = lists.select("gram", "node", "size", "pos").distinct().join(roots, "node", "left")
    rows = rows.withColumn("root", F.coalesce("root", "node"))
    # A list within one component has no such pair. Of the others only rows that some partner's position and size may suit.
    stats = rows.groupBy("gram").agg(
        F.min("root").alias("lo"), F.max("root").alias("hi"), F.min("size").alias("least"), F.min("pos").alias("first")
    )
    rows = rows.join(stats.where("lo <> hi").drop("lo", "hi"), "gram")
    partner = F.greatest(F.col("least"), F.ceil(F.col("size") * num / den)).cast("int")
    rows = rows.where((F.col("size") - F.col("pos")) * (num + den) >= (F.col("size").cast("long") + partner) * num)
    rows = written(rows.select("gram", "node", "size", "pos", "root"), "join-lists")
    x, y = rows.alias("x"), rows.alias("y")
    may = _may_link(F.col("x.size"), F.col("x.pos"), F.col("y.size"), F.col("y.pos"), num, den)
    on = (F.col("x.gram") == F.col("y.gram")) & (F.col("x.node") < F.col("y.node")) & (F.col("x.root") != F.col("y.root")) & may
    pairs = x.join(y, on).select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct()
    return pairs.join(done, ["a", "b"], "left_anti")


# --- verification ---------------------------------------------------------------------------


def _node_map(pairs: DataFrame) -> np.ndarray:
    """Bit map of the nodes in pairs, by their leading bits: 2^MAP_BITS bits, whatever their number."""
    slot = F.shiftrightunsigned("node", 64 - MAP_BITS)
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).select(slot.alias("s"))
    bits = nodes.groupBy(F.shiftright("s", 5).cast("int").alias("w")).agg(
        F.bit_or(F.expr("shiftleft(1L, CAST(s & 31 AS INT))")).alias("b")
    )
    out = np.zeros(1 << MAP_BITS >> 5, dtype=np.int64)
    pdf = bits.toPandas()  # at most 2^(MAP_BITS - 5) rows
    out[pdf["w"].to_numpy(dtype=np.int64)] = pdf["b"].to_numpy(dtype=np.int64)
    return out


def _node_sets(docs: DataFrame, n: int, pairs: DataFrame) -> DataFrame:
    """(node, grams) of the nodes in pairs, from a scan of the texts."""
    bits = docs.sparkSession.sparkContext.broadcast(_node_map(pairs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema("node bigint, grams binary")
        held, seen = bits.value, set()
        for batch in slices(batches, "text"):
            rows = []
            for s in _sets(batch, n):
                node = node_of(s)
                if node is None or node in seen:
                    continue
                slot = (node & (1 << 64) - 1) >> (64 - MAP_BITS)
                if held[slot >> 5] >> (slot & 31) & 1:
                    seen.add(node)
                    rows.append((node, s.astype("<u8").tobytes()))
            if rows:
                yield _batch(rows, schema)

    return to_python(docs.select("text")).mapInArrow(run, "node bigint, grams binary").dropDuplicates(["node"])


def need(both, num: int, den: int):
    """What two sets of ``both`` n-grams in all must share to link."""
    return -(-num * both // (num + den))


def differ_at_least(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Lower bounds of the symmetric differences of sets, from rows of their bin counts."""
    return np.abs(x.astype(np.int16) - y.astype(np.int16)).sum(axis=1)


def similar(x: np.ndarray, y: np.ndarray, num: int, den: int) -> bool:
    return len(np.intersect1d(x, y, assume_unique=True)) >= need(len(x) + len(y), num, den)


def _suffix_filter(pairs: DataFrame, nodes: DataFrame, num: int, den: int) -> DataFrame:
    """``pairs`` without those whose bin counts already tell that they differ too far."""
    bins = nodes.where("bins IS NOT NULL").groupBy("node").agg(F.first("n_shingles").alias("n"), F.first("bins").alias("bins"))
    both = pairs.join(bins.toDF("a", "m", "x"), "a").join(bins.toDF("b", "n", "y"), "b").select("a", "b", "m", "n", "x", "y")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (np.frombuffer(b"".join(column(batch, c).to_pylist()), np.uint8).reshape(-1, BINS) for c in ("x", "y"))
            size = column(batch, "m").to_numpy() + column(batch, "n").to_numpy()
            keep = differ_at_least(x, y) <= size - 2 * need(size, num, den)
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    return both.mapInArrow(run, "a bigint, b bigint")


def _links(docs: DataFrame, n: int, num: int, den: int, pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs that link: suffix filter, then each verified once on whole sets."""
    pairs = written(_suffix_filter(pairs, nodes, num, den), "join-plausible")
    if pairs.isEmpty():
        return pairs
    sets = _node_sets(docs, n, pairs)
    both = pairs.join(sets.toDF("a", "x"), "a").join(sets.toDF("b", "y"), "b").select("a", "b", "x", "y")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema("a bigint, b bigint")
        for batch in batches:
            rows = []
            for a, b, x, y in zip(*(column(batch, c).to_pylist() for c in ("a", "b", "x", "y"))):
                if similar(np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8"), num, den):
                    rows.append((a, b))
            if rows:
                yield _batch(rows, schema)

    return both.mapInArrow(run, "a bigint, b bigint")


# --- components -----------------------------------------------------------------------------


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node in ``links`` (a, b): root is the least node it is connected with.

    Alternating large stars and small stars until nothing changes; each step is
    two aggregations and joins over a written table, so neither long chains nor
    nodes with very many links gather in one task.
    """
    edges = written(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "stars")
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))
        )
        edges = written(small.where("u <> v").distinct(), "stars")
        now = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == state:
            break
        state = now
    roots = edges.select(F.col("v").alias("node")).distinct().withColumn("root", F.col("node"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def near_classes(docs: DataFrame, n: int = 5, num: int = 8, den: int = 10) -> DataFrame:
    """doc_id, n_shingles, node, component_id of every row; links at Jaccard >= num / den.

    A-Z count as a-z; words are runs without ``[\\x20\\x09-\\x0D]``. Documents without
    words (null, empty or white) have no node and link with nothing: component_id
    is their own doc_id. component_id is the smallest doc_id of the component
    (null only if no member has one). Repeated rows are members of their class
    like any other; other columns are not read. An empty table gives an
    empty result.
    """
    spark = docs.sparkSession
    found = written(_nodes(docs, n), "join-nodes")
    frequencies = spark.sparkContext.broadcast(_frequencies(found))
    lists = written(_lists(written(_prefixes(docs, n, num, den, frequencies), "join-prefixes")), "join-lists")
    first = written(_hub_pairs(lists, num, den), "join-pairs")
    links = written(_links(docs, n, num, den, first, found), "join-links")
    roots = written(components(links), "join-roots")
    second = written(_cross_pairs(lists, roots, first, num, den), "join-pairs")
    more = written(_links(docs, n, num, den, second, found), "join-links")
    if not more.isEmpty():
        # The components so far, as stars, with the new links between them.
        stars = roots.select(F.col("node").alias("a"), F.col("root").alias("b"))
        roots = written(components(stars.unionByName(more)), "join-roots")
    rows = found.where("block IS NULL").select("doc_id", "n_shingles", "node")
    least = rows.where("node IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("least"))
    placed = least.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    named = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = placed.join(named, "root").select(F.col("node").alias("_node"), "component_id")
    out = rows.join(labels, F.col("node") == F.col("_node"), "left")
    own = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", "node", own.alias("component_id"))


def with_node(docs: DataFrame, n: int, name: str) -> DataFrame:
    """``docs`` with the node of each text as one more column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            yield batch.append_column(name, pa.array([node_of(s) for s in _sets(batch, n)], pa.int64()))

    return to_python(docs).mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, T.LongType())]))


def keep_one(docs: DataFrame, n: int = 5, num: int = 8, den: int = 10) -> DataFrame:
    """The rows of ``docs`` that stay, one of each group of near copies, with all their columns.

    The row with the smallest doc_id of its component stays (of rows that
    repeat it, one). Documents without words all stay.
    """
    classes = written(near_classes(docs, n, num, den).where("node IS NOT NULL"), "near-classes")
    rows = classes.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    node, i, m, c = (free_name(docs, f"_near_{k}") for k in ("node", "id", "least", "rows"))
    # One node of the smallest doc_id: a doc_id may stand more than once in a component.
    # A component without any doc_id is known by its node.
    nameless = F.when(F.col("component_id").isNull(), F.col("node"))
    stay = rows.groupBy(F.col("component_id").alias(i), nameless.alias("nameless")).agg(F.min("node").alias(m)).drop("nameless")
    count = rows.groupBy(F.col("doc_id").alias("of"), F.col("node").alias("at")).agg(F.count(F.lit(1)).alias(c))
    stay = stay.join(count, (F.col(m) == F.col("at")) & F.col(i).eqNullSafe(F.col("of"))).select(i, m, c)
    stay = written(stay, "near-stay")
    mine = with_node(docs, n, node).alias("m")

    def matched(of: DataFrame) -> DataFrame:
        return mine.join(of, (F.col(node) == F.col(m)) & F.col("m.doc_id").eqNullSafe(F.col(i))).select("m.*")

    empty = mine.where(F.col(node).isNull())
    if stay.where(F.col(c) > 1).isEmpty():
        return matched(stay).unionByName(empty).select(*docs.columns)
    once = matched(stay.where(F.col(c) > 1)).dropDuplicates(["doc_id", node])
    return matched(stay.where(F.col(c) == 1)).unionByName(once).unionByName(empty).select(*docs.columns)
