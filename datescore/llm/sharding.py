"""Sharding (1): a consistent-hash ring with virtual nodes and bounded loads.

Each shard owns ``replicas`` points on a ring of 64-bit hashes; a document goes
to the first point at or after the hash of its doc_id. A shard takes at most
its capacity; what overflows walks on clockwise to the next point whose shard
has room. In each step of the walk the documents of an arc (the stretch before
one point) stand together, so the walk is decided on counts per arc alone: a
table of shards x replicas rows, whatever the size of the input. Its outcome
is a list of intervals "documents i to j of arc a go to shard s from slot t",
at most shards x arcs of them, since an arc gets room in a shard at most once.

At scale: the texts are read once and reduced to size and checksum in the scan.
Documents are ranked inside their arc by (sub-arc, hash), so a window holds one
of shards x replicas x SUB_ARCS pieces. Rows that repeat in full are counted
before the shuffle and repeated in blocks at the end.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from datescore.llm.common import ranked, repeat_rows, text_or_empty, written

REPLICAS = 128
SUB_ARCS = 16


def ring(shards: int, replicas: int = REPLICAS) -> tuple[np.ndarray, np.ndarray]:
    """Positions (sorted signed 64-bit) of the virtual nodes and the shard of each.

    A node's position depends on its shard and replica number only, so a new
    shard adds its own nodes and moves none.
    """
    points = sorted(
        (int.from_bytes(hashlib.blake2b(f"{s}/{r}".encode(), digest_size=8).digest(), "big", signed=True), s)
        for s in range(shards)
        for r in range(replicas)
    )
    position, owner = zip(*points)
    return np.array(position, dtype=np.int64), np.array(owner, dtype=np.int64)


def capacities(total: int, shards: int, slack: float = 0.0) -> list[int]:
    """Room of each shard. With ``slack`` 0 the rooms add up to ``total`` and differ by one at most."""
    if slack:
        return [-(-int(total * (1 + slack)) // shards) + 1] * shards
    return [total // shards + (s < total % shards) for s in range(shards)]


def walk(owner: np.ndarray, load: np.ndarray, room: list[int]) -> list[tuple[int, int, int, int, int]]:
    """Clockwise overflow on counts: (arc, first, end, shard, slot of the first).

    In step k every arc's documents that have no place yet stand k points
    clockwise of their own; a shard with room takes them in ring order. The
    lowest ranks of an arc are placed first, so an arc's documents that stay at home
    are a prefix. Ends when all are placed.
    """
    n = len(owner)
    used = [0] * len(room)
    placed = np.zeros(n, dtype=np.int64)
    waiting = [a for a in range(n) if load[a]]
    out = []
    for step in range(n):
        if not waiting:
            break
        still = []
        for arc in waiting:
            shard = int(owner[(arc + step) % n])
            take = min(int(load[arc] - placed[arc]), room[shard] - used[shard])
            if take > 0:
                first = int(placed[arc])
                out.append((arc, first, first + take, shard, used[shard]))
                used[shard] += take
                placed[arc] += take
            if placed[arc] < load[arc]:
                still.append(arc)
        waiting = still
    if waiting:
        raise ValueError("the shards have less room than there are documents")
    return out


def arc_of(position: np.ndarray):
    """Column function: the ring arc of a 64-bit hash (vectorised binary search)."""

    @F.pandas_udf(T.IntegerType())
    def arc(h: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(position, h.to_numpy()) % len(position), dtype="int32")

    return arc


def shard_documents(docs: DataFrame, shards: int = 24, replicas: int = REPLICAS, slack: float = 0.0) -> DataFrame:
    """Every row of ``docs`` with its shard and slot: doc_id, size, text_crc32, shard, slot, moved.

    ``slack`` is how far a shard may be above the mean (0: counts differ by one
    at most; 0.05: at most 5 % above, with fewer documents away from their home
    shard). ``moved`` tells rows that overflowed. Null text has no bytes (size
    8, checksum of the empty text). A null doc_id has a hash like any other.
    Rows equal in doc_id, size and checksum are interchangeable and get
    slots of their own; a repeated doc_id with other text is a row like any other. An empty
    table gives an empty result. Other columns are not read.
    """
    if shards < 1:
        raise ValueError("at least one shard is needed")
    spark = docs.sparkSession
    position, owner = ring(shards, replicas)
    data = text_or_empty().cast("binary")
    rows = docs.select(
        "doc_id",
        (F.octet_length(data) + 8).cast("long").alias("size"),
        F.crc32(data).alias("text_crc32"),
        F.xxhash64("doc_id").alias("h"),
    )
    # Rows that repeat in full become one row with a count, before any shuffle by arc.
    rows = rows.groupBy("doc_id", "size", "text_crc32", "h").agg(F.count(F.lit(1)).alias("copies"))
    rows = rows.withColumn("arc", arc_of(position)("h"))
    rows = written(rows.withColumn("sub", F.pmod(F.xxhash64("h"), F.lit(SUB_ARCS)).cast("int")), "shard-rows")
    placed, totals = ranked(rows, "arc", "copies", ["h", "doc_id", "text_crc32", "size"], "sub", "rank")
    load = np.zeros(len(position), dtype=np.int64)
    for arc, total in totals.collect():  # one row per virtual node
        load[arc] = total
    steps = walk(owner, load, capacities(int(load.sum()), shards, slack))
    steps = [(*s, int(owner[s[0]]) != s[3]) for s in steps]
    intervals = spark.createDataFrame(steps, "arc int, first long, end long, shard int, slot0 long, moved boolean")
    last = F.col("rank") + F.col("copies")
    # The part of a row's copies that lies in the interval; a single row lies in exactly one.
    start = F.greatest("rank", "first")
    cut = placed.join(F.broadcast(intervals), "arc").where((F.col("rank") < F.col("end")) & (last > F.col("first")))
    cut = cut.select(
        "doc_id",
        "size",
        "text_crc32",
        "shard",
        (F.col("slot0") + start - F.col("first")).alias("slot"),
        (F.least(last, F.col("end")) - start).alias("copies"),
        "moved",
    )
    return repeat_rows(cut, "copies", "slot").drop("copies")
