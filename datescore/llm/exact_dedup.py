"""Exact dedup (7): a cuckoo-filter index of live digests over bucketed keys.

Two texts are equal when they are the same after every character of
``[\\x20\\x09-\\x0D]`` is deleted; the digest is the SHA-256 of that normal form.

The index is a table in the shared folder, one row per bucket of the digest
space: the bucket's cuckoo filter (four 16-bit fingerprints a cell) and its
content, i.e. the stored digests with the row that represents each. The index
decides which texts are equal: rows are inserted in batches, each asks the filter
first; a miss is a new text and is stored without a look at the content; a hit is
verified against the bucket's stored keys, and if it is a copy it may become the
representative. A filter that overflows is doubled and refilled from the stored
keys. Deleting takes a live digest out of both. Buckets are split as keys come in
(linear hashing), so a bucket holds about KEYS_PER_BUCKET of them at any size.

A change rewrites only the buckets it touches, as a new version beside the old
ones; the directory (bucket, version) says which rows are live, and after
VERSIONS versions the live rows are written together.

At scale: texts are reduced to 32 bytes by Spark's own functions in the scan; a
task collapses the copies it meets, so a text copied into a third of all rows is
one row for each task; the rest goes to its bucket. A bucket whose documents
exceed 1/1024 of the table is dealt to several tasks in the probe, each with its
own copy of that bucket. Probing streams: a task holds one bucket and one Arrow batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from datescore.llm.common import WHITE, column, free_name, parallelism, scratch, text_or_empty, written

DIGEST = 32
CELL = 4  # fingerprints in a cell
MAX_KICKS = 200
KEYS_PER_BUCKET = 20_000
LEAST_BUCKETS = 256
CHUNK = 4096  # rows that ask a filter together
HELD = 100_000  # digests that a task collapses before it sends them on
VERSIONS = 8
SPREAD = 1024  # a bucket with more than 1/SPREAD of the rows goes to several tasks

CONTENT = "digest binary, keep_id bigint, keep_chars bigint, group_size bigint"
BUCKETS = (
    "bucket int, filter binary, digests binary, keep_ids array<bigint>, keep_chars array<bigint>, group_sizes array<bigint>"
)


# --- the filter ---------------------------------------------------------------------


def _parts(digests: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprint (16 bits, never 0) and hash (32 bits) of an (n, 32) byte array."""
    fp = digests[:, 8].astype(np.uint32) * 255 + digests[:, 9] % 255 + 1
    h = np.ascontiguousarray(digests[:, 10:14]).view("<u4").ravel()
    return fp & 0xFFFF | (fp & 0xFFFF == 0), h


def _other(cell, fp, mask):
    """The second cell of a fingerprint; its own inverse."""
    return (cell ^ (fp * 0x5BD1E995 & 0xFFFFFFFF)) & mask


class CuckooFilter:
    """Approximate membership with deletion: no false negatives for inserted keys.

    ``insert`` returns False when no place is found within MAX_KICKS moves;
    the owner then rebuilds a larger filter from the keys it stores.
    """

    def __init__(self, cells: int = 64, table: np.ndarray | None = None):
        self.table = np.zeros((cells, CELL), dtype=np.uint16) if table is None else table

    @property
    def mask(self) -> int:
        return len(self.table) - 1

    @classmethod
    def of(cls, digests: np.ndarray) -> CuckooFilter:
        """A filter that holds all ``digests``, doubled until they fit."""
        cells = 64
        while cells * CELL * 0.9 < len(digests):
            cells *= 2
        while True:
            out = cls(cells)
            if out.insert_all(digests):
                return out
            cells *= 2

    @classmethod
    def load(cls, data: bytes) -> CuckooFilter:
        return cls(table=np.frombuffer(data, dtype="<u2").reshape(-1, CELL).copy())

    def dump(self) -> bytes:
        return self.table.astype("<u2").tobytes()

    def insert_all(self, digests: np.ndarray) -> bool:
        fps, hashes = _parts(digests)
        return all(self._insert(int(f), int(h)) for f, h in zip(fps, hashes))

    def _insert(self, fp: int, h: int) -> bool:
        cell = h & self.mask
        for c in (cell, _other(cell, fp, self.mask)):
            free = np.flatnonzero(self.table[c] == 0)
            if len(free):
                self.table[c, free[0]] = fp
                return True
        for kick in range(MAX_KICKS):
            slot = (kick * 7 + fp) % CELL
            fp, self.table[c, slot] = int(self.table[c, slot]), fp
            c = _other(c, fp, self.mask)
            free = np.flatnonzero(self.table[c] == 0)
            if len(free):
                self.table[c, free[0]] = fp
                return True
        return False

    def delete_all(self, digests: np.ndarray) -> None:
        """Take out one fingerprint for each digest; only digests that were inserted may be given."""
        fps, hashes = _parts(digests)
        for fp, h in zip(fps, hashes):
            cell = int(h) & self.mask
            for c in (cell, _other(cell, int(fp), self.mask)):
                held = np.flatnonzero(self.table[c] == fp)
                if len(held):
                    self.table[c, held[0]] = 0
                    break

    def hits(self, digests: np.ndarray) -> np.ndarray:
        if not len(digests):
            return np.zeros(0, dtype=bool)
        fps, hashes = _parts(digests)
        first = hashes.astype(np.int64) & self.mask
        second = _other(first, fps.astype(np.int64), self.mask)
        want = fps[:, None]
        return (self.table[first] == want).any(axis=1) | (self.table[second] == want).any(axis=1)


def _matrix(digests) -> np.ndarray:
    """Digests as an (n, 32) byte array."""
    data = digests if isinstance(digests, bytes) else b"".join(digests)
    return np.frombuffer(data, dtype=np.uint8).reshape(-1, DIGEST)


class _Bucket:
    """One row of the index in memory: the filter and the content it guards."""

    def __init__(self, row=None):
        self.filter = CuckooFilter.load(bytes(row.filter)) if row is not None else CuckooFilter()
        stored = _matrix(bytes(row.digests)) if row is not None else np.zeros((0, DIGEST), np.uint8)
        self.content = (
            {bytes(d): (i, c, n) for d, i, c, n in zip(stored, _longs(row.keep_ids), row.keep_chars, row.group_sizes)}
            if row is not None
            else {}
        )

        self.reads = 0  # digests looked up in the content

    def _verify(self, digest: bytes) -> tuple | None:
        self.reads += 1
        return self.content.get(digest)

    def probe(self, digests: list[bytes]) -> list[tuple | None]:
        hit = self.filter.hits(_matrix(digests))
        return [self._verify(d) if h else None for d, h in zip(digests, hit)]

    def put(self, rows: list[tuple]) -> None:
        """Insert (digest, keep_id, keep_chars, group_size) in chunks; a live digest keeps its better row and adds sizes.

        A chunk's own copies collapse; then the filter is asked. Misses are new
        and stored at once, hits are verified.
        """
        for start in range(0, len(rows), CHUNK):
            chunk: dict[bytes, tuple] = {}
            for d, *row in rows[start : start + CHUNK]:
                chunk[d] = better(chunk.get(d), tuple(row))
            digests = list(chunk)
            fresh = []
            for d, hit in zip(digests, self.filter.hits(_matrix(digests))):
                known = self._verify(d) if hit else None
                if known is None:
                    fresh.append(d)
                    self.content[d] = chunk[d]
                else:
                    self.content[d] = better(known, chunk[d])
            if fresh and not self.filter.insert_all(_matrix(fresh)):
                self.filter = CuckooFilter.of(_matrix(list(self.content)))

    @classmethod
    def of(cls, content: dict[bytes, tuple]) -> _Bucket:
        """A bucket of stored keys, its filter built from them."""
        out = cls()
        out.content = content
        if content:
            out.filter = CuckooFilter.of(_matrix(list(content)))
        return out

    def drop(self, digests: list[bytes]) -> None:
        live = [d for d, known in zip(digests, self.probe(digests)) if known is not None]
        live = list(dict.fromkeys(live))
        if live:
            self.filter.delete_all(_matrix(live))
        for d in live:
            del self.content[d]

    def row(self, bucket: int) -> pd.DataFrame:
        ids, chars, sizes = zip(*self.content.values()) if self.content else ((), (), ())
        return pd.DataFrame(
            {
                "bucket": [bucket],
                "filter": [self.filter.dump()],
                "digests": [b"".join(self.content)],
                "keep_ids": [list(ids)],
                "keep_chars": [list(chars)],
                "group_sizes": [list(sizes)],
            }
        )


def better(a: tuple | None, b: tuple) -> tuple:
    """(keep_id, keep_chars, group_size) of two groups of one text: more characters, then the smaller id (null last)."""
    if a is None:
        return b
    (i, c, n), (k, d, m) = a, b
    second = d > c or (d == c and k is not None and (i is None or k < i))
    return (k if second else i, d if second else c, n + m)


def _longs(values) -> list[int | None]:
    """Pandas may hand a nullable array over as floats or objects."""
    return [None if v is None or v != v else int(v) for v in values]


def bucket_number(h, n: int):
    """Linear hashing: bucket of the hash ``h`` (integers or an array) among ``n``; one more bucket moves keys of one only."""
    m = 1 << max(0, n - 1).bit_length()
    b = h % m
    return np.where(b >= n, b - m // 2, b)


def _bucket_of(n: int) -> Column:
    """``bucket_number`` of the first 32 bits of ``digest``."""
    m = 1 << max(0, n - 1).bit_length()
    b = F.pmod(F.conv(F.hex(F.substring(F.col("digest"), 1, 4)), 16, 10).cast("long"), F.lit(m))
    return F.when(b >= n, b - m // 2).otherwise(b).cast("int")


def _hashes(digests: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(digests[:, :4]).view(">u4").ravel().astype(np.int64)


class CuckooIndex:
    """Live digests with their representatives; insert, delete, probe.

    Every change writes the buckets it touches as a new version next to the old
    ones, so a failed job leaves the last version as it was.
    """

    def __init__(
        self,
        spark: SparkSession,
        n_keys: int = 0,
        path: str | None = None,
        keys_per_bucket: int = KEYS_PER_BUCKET,
        least_buckets: int = LEAST_BUCKETS,
    ):
        """``n_keys``: about how many are expected; only where to begin, as buckets are split."""
        self.spark = spark
        self.keys_per_bucket = keys_per_bucket
        self.n_buckets = max(least_buckets, -(-n_keys // keys_per_bucket))
        self.path = path or scratch(spark, "cuckoo-index")
        self.version = 0
        self.first = 0  # versions before it are no longer read
        self._rows([]).write.parquet(f"{self.path}/rows/version=0")
        spark.createDataFrame([], "bucket int, live int").write.parquet(f"{self.path}/directory/{self.version}")

    def _rows(self, rows: list) -> DataFrame:
        return self.spark.createDataFrame(rows, BUCKETS)

    def directory(self) -> DataFrame:
        """(bucket, live): the version that holds each bucket."""
        return self.spark.read.schema("bucket int, live int").parquet(f"{self.path}/directory/{self.version}")

    def table(self) -> DataFrame:
        """The live rows."""
        parts = [f"{self.path}/rows/version={v}" for v in range(self.first, self.version + 1)]
        schema = self._rows([]).schema.add("version", IntegerType())
        rows = self.spark.read.schema(schema).option("basePath", f"{self.path}/rows").parquet(*parts)
        live = self.directory().withColumnRenamed("bucket", "_b")
        return rows.join(live, (F.col("bucket") == F.col("_b")) & (F.col("version") == F.col("live"))).drop("_b", "live", "version")

    def _write(self, rows: DataFrame, whole: bool = False) -> None:
        """``rows`` are the new state of their buckets; all others stay (or go, if ``rows`` are the ``whole`` index)."""
        old, version = self.directory(), self.version + 1
        rows.write.parquet(f"{self.path}/rows/version={version}")
        new = self.spark.read.parquet(f"{self.path}/rows/version={version}").select("bucket", F.lit(version).alias("live"))
        kept = old.join(new.select("bucket"), "bucket", "left_anti")
        (new if whole else kept.unionByName(new)).write.parquet(f"{self.path}/directory/{version}")
        self.version = version
        if whole:
            self.first = version

    def _change(self, changes: DataFrame) -> None:
        changes = written(changes.withColumn("bucket", _bucket_of(self.n_buckets)), "dedup-changes")
        touched = self.table().join(changes.select("bucket").distinct(), "bucket", "left_semi")
        both = changes.unionByName(touched, allowMissingColumns=True)

        def apply(pdf: pd.DataFrame) -> pd.DataFrame:
            old = pdf[pdf["filter"].notna()]
            new = pdf[pdf["filter"].isna()]
            bucket = _Bucket(next(old.itertuples())) if len(old) else _Bucket()
            add = new[~new["gone"].astype(bool)]
            bucket.put(
                list(
                    zip(
                        map(bytes, add["digest"]),
                        _longs(add["keep_id"]),
                        _longs(add["keep_char"]),
                        _longs(add["group_size"]),
                    )
                )
            )
            bucket.drop([bytes(d) for d in new.loc[new["gone"].astype(bool), "digest"]])
            return bucket.row(int(pdf["bucket"].iloc[0]))

        self._write(both.groupBy("bucket").applyInPandas(apply, self._rows([]).schema))
        self._split()
        if self.version - self.first >= VERSIONS:
            self._write(self.table(), whole=True)

    def n_keys(self) -> int:
        """Live digests."""
        return (self.table().agg(F.sum(F.octet_length("digests"))).first()[0] or 0) // DIGEST

    def _split(self) -> None:
        """More buckets for more keys; only the buckets whose keys move are read and written."""
        n, more = self.n_buckets, -(-self.n_keys() // self.keys_per_bucket)
        if more <= n:
            return

        def split(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in frames:
                for row in pdf.itertuples():
                    old = _Bucket(row)
                    to = bucket_number(_hashes(_matrix(list(old.content))), more) if old.content else np.array([row.bucket])
                    parts: dict[int, dict] = {int(row.bucket): {}}
                    for b, (d, value) in zip(to.tolist(), old.content.items()):
                        parts.setdefault(b, {})[d] = value
                    for b, content in parts.items():
                        yield _Bucket.of(content).row(b)

        # New buckets take keys from these, step by step of the growth.
        parents = self.spark.range(n, more).select(F.col("id").alias("b"))
        while True:  # a new bucket's parent may itself be new; log2(more / n) steps
            m = F.pow(F.lit(2), F.ceil(F.log2(F.col("b") + 1)) - 1).cast("long")
            parents = parents.select(F.when(F.col("b") >= n, F.col("b") - m).otherwise(F.col("b")).alias("b")).distinct()
            if parents.where(F.col("b") >= n).isEmpty():
                break
        moved = self.table().join(parents.select(F.col("b").cast("int").alias("bucket")), "bucket", "left_semi")
        self._write(moved.mapInPandas(split, self._rows([]).schema))
        self.n_buckets = more

    def insert(self, rows: DataFrame) -> None:
        """``rows``: digest (binary), keep_id, keep_chars, group_size; several rows of a digest are groups of one text."""
        self._change(
            rows.select("digest", "keep_id", F.col("keep_chars").alias("keep_char"), "group_size", F.lit(False).alias("gone"))
        )

    def delete(self, digests: DataFrame) -> None:
        """Take the digests out; those that are not live are ignored."""
        none = F.lit(None).cast("long")
        self._change(
            digests.select(
                "digest", none.alias("keep_id"), none.alias("keep_char"), none.alias("group_size"), F.lit(True).alias("gone")
            )
        )

    def probe(self, rows: DataFrame) -> DataFrame:
        """``rows`` (digest binary, doc_id, n_chars) with found, keep_id, keep_chars, group_size.

        ``first`` tells the first of rows that repeat doc_id, digest and n_chars.
        """
        rows = rows.select("digest", "doc_id", "n_chars").withColumn("bucket", _bucket_of(self.n_buckets))
        loads = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
        # At most SPREAD buckets can hold more than 1/SPREAD of all rows: a bounded broadcast.
        total = loads.agg(F.sum("n").alias("total"))
        hot = loads.join(F.broadcast(total)).where(F.col("n") * SPREAD > F.col("total"))
        salts = F.broadcast(hot.select("bucket", F.ceil(F.col("n") * SPREAD / F.col("total")).cast("int").alias("salts")))
        n = F.coalesce(F.col("salts"), F.lit(1))
        asked = rows.join(salts, "bucket", "left").withColumn("salt", F.pmod(F.xxhash64("doc_id", "n_chars"), n).cast("int"))
        kept = self.table().join(salts, "bucket", "left").withColumn("salt", F.explode(F.sequence(F.lit(0), n - 1)))
        both = asked.drop("salts").withColumn("asks", F.lit(1)).unionByName(
            kept.drop("salts").withColumn("asks", F.lit(0)), allowMissingColumns=True
        )
        dealt = both.repartition(parallelism(self.spark), "bucket", "salt").sortWithinPartitions(
            "bucket", "salt", "asks", "digest", "doc_id", "n_chars"
        )
        return dealt.mapInPandas(
            _answers,
            "digest binary, doc_id bigint, n_chars bigint, found boolean, keep_id bigint, keep_chars bigint,"
            " group_size bigint, first boolean",
        )


def _answers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Index rows come before the rows that ask; one bucket is held at a time."""
    bucket, held, last = _Bucket(), None, None
    for pdf in batches:
        out = []
        for row in pdf.itertuples(index=False):
            if row.asks == 0:
                bucket, held = _Bucket(row), row.bucket
                continue
            if row.bucket != held:
                bucket, held = _Bucket(), row.bucket
            out.append((bytes(row.digest), *_longs([row.doc_id, row.n_chars]), bucket))
        result = []
        at = 0
        while at < len(out):
            stop = at
            while stop < len(out) and out[stop][3] is out[at][3]:
                stop += 1
            for (d, i, c, _), known in zip(out[at:stop], out[at][3].probe([r[0] for r in out[at:stop]])):
                result.append((d, i, c, known is not None, *(known or (None, None, None)), (d, i, c) != last))
                last = (d, i, c)
            at = stop
        yield pd.DataFrame(
            {
                name: pd.Series([r[k] for r in result], dtype=kind)
                for k, (name, kind) in enumerate(
                    [
                        ("digest", "object"),
                        ("doc_id", "Int64"),
                        ("n_chars", "Int64"),
                        ("found", "boolean"),
                        ("keep_id", "Int64"),
                        ("keep_chars", "Int64"),
                        ("group_size", "Int64"),
                        ("first", "boolean"),
                    ]
                )
            }
        )


# --- dedup --------------------------------------------------------------------------


def digest_of(text=None):
    """SHA-256 (binary) of the text without the contract's white space; null counts as empty."""
    return F.unhex(F.sha2(F.translate(text_or_empty() if text is None else text, WHITE, ""), 256))


def _keys(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", digest_of().alias("digest"), F.length(text_or_empty()).cast("long").alias("n_chars"))


def collapsed(keys: DataFrame) -> DataFrame:
    """``keys`` as groups (digest, keep_id, keep_chars, group_size): the copies that a task meets are one row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, tuple] = {}

        def out() -> pa.RecordBatch:
            ids, chars, sizes = zip(*held.values())
            arrays = [pa.array(list(held), pa.binary()), *(pa.array(v, pa.int64()) for v in (ids, chars, sizes))]
            return pa.RecordBatch.from_arrays(arrays, names=["digest", "keep_id", "keep_chars", "group_size"])

        for batch in batches:
            for d, i, c in zip(*(column(batch, name).to_pylist() for name in ("digest", "doc_id", "n_chars"))):
                held[d] = better(held.get(d), (i, c, 1))
            if len(held) >= HELD:
                yield out()
                held = {}
        if held:
            yield out()

    return keys.select("digest", "doc_id", "n_chars").mapInArrow(run, CONTENT)


def classes(keys: DataFrame, index: CuckooIndex | None = None) -> DataFrame:
    """``keys`` (digest, doc_id, n_chars) with keep_id, keep_chars, group_size and kept."""
    if index is None:
        # Only where to begin: buckets are split as keys come in.
        index = CuckooIndex(keys.sparkSession, keys.count())
    index.insert(collapsed(keys))
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("n_chars") == F.col("keep_chars")) & F.col("first")
    return index.probe(keys).withColumn("kept", kept)


def exact_dedup(docs: DataFrame, index: CuckooIndex | None = None) -> DataFrame:
    """Classes of equal texts: doc_id, keep_id, group_size, kept, text_sha256 for every row.

    Null text counts as empty, so null and empty texts form one class. Rows
    that repeat a doc_id are separate members of their class; when the row
    that stays is itself repeated, one of the copies is kept. An empty table
    gives an empty result. Columns other than doc_id and text are not read.
    With an ``index`` from earlier batches the classes go on from its content.
    """
    keys = written(_keys(docs), "dedup-keys")
    return classes(keys, index).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, one per class, with all their columns.

    One shuffle of the texts, by (digest, doc_id), so a hot class is spread
    out. Rows that repeat the row that stays (same doc_id, same text) collapse
    to one of the longest. Other columns may have any name; the working
    columns take free ones.
    """
    keys = written(_keys(docs), "dedup-keys")
    d, k, i, n = (free_name(docs, f"_dedup_{c}") for c in ("digest", "keep", "id", "rows"))
    same = keys.groupBy(F.col("digest").alias("of"), F.col("doc_id").alias("at")).agg(F.count(F.lit(1)).alias(n))
    stay = classes(keys).where("kept").select(F.col("digest").alias(k), F.col("doc_id").alias(i))
    stay = written(stay.join(same, (F.col(k) == F.col("of")) & F.col(i).eqNullSafe(F.col("at"))).select(k, i, n), "dedup-stay")
    mine = docs.withColumn(d, digest_of()).alias("m")

    def rows(of: DataFrame) -> DataFrame:
        return mine.join(of, (F.col(d) == F.col(k)) & F.col("m.doc_id").eqNullSafe(F.col(i))).select("m.*")

    if stay.where(F.col(n) > 1).isEmpty():
        return rows(stay).select(*docs.columns)
    longest = Window.partitionBy(d).orderBy(F.length(text_or_empty()).desc())
    once = rows(stay.where(F.col(n) > 1)).withColumn(n, F.row_number().over(longest)).where(F.col(n) == 1)
    return rows(stay.where(F.col(n) == 1)).select(*docs.columns).unionByName(once.select(*docs.columns))
