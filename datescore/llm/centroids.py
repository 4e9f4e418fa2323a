"""Centroid clustering by scalar lookup tables (11).

Components become integers, floor(256 * x), so a squared difference depends on
three things only: the dimension, the integer and the centroid. Vectors are
written once in blocks of up to BLOCK: the integers that occur in each dimension
of the block, and for every vector the number of its integer in that list. A
round tabulates the squared differences of the occurring integers against all
centroids, and the distances of the block are table gathers, added up over the
dimensions. A task sends one row for each centroid: its count and its sums.

What is on the driver is the centroids (K x 64 numbers) and K rows a round; a
block's table has at most 64 x BLOCK x K entries, whatever the input's size.

Defined results: vectors that are null, of another length, or with a null, NaN
or infinite component are left out. A null id stays null (and hashes as ``2:``).
Repeated ids and equal vectors are rows of their own; where ids repeat, the
order of the first centroids is decided by the components. With fewer vectors
than centroids every vector is a centroid; an empty table gives no rows. A
component beyond +-2^19 (an integer beyond LIMIT) is an error, as its distances
could exceed a long. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from datescore.llm.common import arrow_schema, column, release, written

DIMS = 64
CENTROIDS = 40
ROUNDS = 5
SCALE = 256
SEED = 2
BLOCK = 4096
LIMIT = 1 << 27  # (2 * LIMIT)^2 * DIMS is below 2^63

_BLOCKS = pa.schema(
    [("ids", pa.list_(pa.int64())), ("counts", pa.list_(pa.int32())), ("occurring", pa.list_(pa.int64())), ("codes", pa.binary())]
)
_BLOCKS_DDL = "ids array<bigint>, counts array<int>, occurring array<bigint>, codes binary"


def whole_vectors(ids: pa.Array, vectors: pa.Array, dims: int = DIMS) -> tuple[pa.Array, np.ndarray]:
    """Ids and integers (n, dims) of the vectors that have ``dims`` components, none null, NaN or infinite."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    right = pc.fill_null(pc.equal(pc.list_value_length(vectors), dims), False)
    ids, vectors = ids.filter(right), vectors.filter(right)
    flat = pc.cast(vectors.flatten(), pa.float64())
    x = flat.to_numpy(zero_copy_only=False).reshape(-1, dims)  # a null component is a NaN here
    finite = np.isfinite(x).all(axis=1)
    whole = np.floor(SCALE * x[finite])
    if whole.size and np.abs(whole).max() > LIMIT:
        raise ValueError(f"a component is beyond +-{LIMIT // SCALE}: its distances could exceed a long")
    return ids.filter(pa.array(finite)), whole.astype(np.int64)


def _block(ids: pa.Array, x: np.ndarray) -> pa.RecordBatch:
    """The occurring integers of each dimension and, for every vector, their numbers."""
    codes = np.empty((x.shape[1], x.shape[0]), dtype="<u2")
    occurring = []
    for d in range(x.shape[1]):
        values, codes[d] = np.unique(x[:, d], return_inverse=True)
        occurring.append(values)
    counts = np.array([len(v) for v in occurring], dtype=np.int32)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([ids.to_pylist()], _BLOCKS.field("ids").type),
            pa.array([counts], _BLOCKS.field("counts").type),
            pa.array([np.concatenate(occurring)], _BLOCKS.field("occurring").type),
            pa.array([codes.tobytes()], pa.binary()),
        ],
        schema=_BLOCKS,
    )


def blocks(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", dims: int = DIMS) -> DataFrame:
    """The vectors that count, as blocks of integer codes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, parts, held = [], [], 0
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK):
                piece = batch.slice(start, BLOCK)
                some, x = whole_vectors(column(piece, "id"), column(piece, "vector"), dims)
                ids.append(some)
                parts.append(x)
                held += len(x)
                if held >= BLOCK:
                    all_ids, all_x = pa.concat_arrays(ids), np.concatenate(parts)
                    yield _block(all_ids.slice(0, BLOCK), all_x[:BLOCK])
                    ids, parts, held = [all_ids.slice(BLOCK)], [all_x[BLOCK:]], held - BLOCK
        if held:
            yield _block(pa.concat_arrays(ids), np.concatenate(parts))
        release()

    two = vectors.select(F.col(id_column).cast("bigint").alias("id"), F.col(vector_column).alias("vector"))
    return two.mapInArrow(run, _BLOCKS_DDL)


class _Codes:
    """A block read back: its table for given centroids, and what is gathered from it."""

    def __init__(self, batch: pa.RecordBatch, row: int):
        self.ids = column(batch, "ids")[row].values
        self.counts = column(batch, "counts")[row].values.to_numpy()
        self.occurring = column(batch, "occurring")[row].values.to_numpy()
        self.codes = np.frombuffer(column(batch, "codes")[row].as_py(), dtype="<u2").reshape(len(self.counts), -1)
        self.starts = np.cumsum(self.counts) - self.counts

    def nearest(self, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest centroid of every vector (ties: the smaller number) and the squared distance."""
        dims = np.repeat(np.arange(len(self.counts)), self.counts)
        apart = self.occurring[:, None] - centroids.T[dims]
        small = int(np.abs(apart).max()) ** 2 * len(self.counts) < 1 << 31
        table = np.square(apart.astype(np.int32) if small else apart)
        total = np.zeros((self.codes.shape[1], len(centroids)), dtype=table.dtype)
        part = np.empty_like(total)
        for d, (start, count) in enumerate(zip(self.starts, self.counts)):
            np.take(table[start : start + count], self.codes[d], axis=0, out=part, mode="clip")
            total += part
        nearest = total.argmin(axis=1)
        return nearest, total[np.arange(len(total)), nearest].astype(np.int64)

    def sums(self, cluster: np.ndarray, k: int) -> np.ndarray:
        """Componentwise sums of the vectors of each cluster (k, dims); doubles hold them exactly."""
        out = np.empty((k, len(self.counts)), dtype=np.int64)
        for d, (start, count) in enumerate(zip(self.starts, self.counts)):
            values = self.occurring[start : start + count][self.codes[d]]
            out[:, d] = np.bincount(cluster, weights=values, minlength=k).astype(np.int64)
        return out


def _each(batches: Iterator[pa.RecordBatch]) -> Iterator[_Codes]:
    for batch in batches:
        for row in range(batch.num_rows):
            yield _Codes(batch, row)


def first_centroids(vectors: DataFrame, id_column: str, vector_column: str, dims: int, k: int, seed: int) -> np.ndarray:
    """The k vectors with the smallest hash of ``seed:id``, in the order of their hashes."""
    x = F.col(vector_column)
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_column).cast("string"), F.lit("")))
    first = (
        vectors.where((F.size(x) == dims) & finite)
        .select(F.sha2(text, 256).alias("h"), x.cast("array<double>").alias("x"))
        .orderBy("h", "x")
        .limit(k)
        .collect()
    )
    return np.floor(SCALE * np.array([r.x for r in first], dtype=np.float64).reshape(-1, dims)).astype(np.int64)


def next_centroids(table: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """One round: exact floors of the clusters' means; empty clusters keep their centroid."""
    k, dims = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros(k, dtype=np.int64), np.zeros((k, dims), dtype=np.int64)
        for block in _each(batches):
            cluster, _ = block.nearest(centroids)
            counts += np.bincount(cluster, minlength=k)
            sums += block.sums(cluster, k)
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(some.astype(np.int32)), pa.array(counts[some]), pa.array(list(sums[some]), pa.list_(pa.int64()))],
            names=["cluster", "n", "sums"],
        )
        release()

    parts = table.mapInArrow(run, "cluster int, n bigint, sums array<bigint>")
    totals = parts.groupBy("cluster").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.col("sums")[d]) for d in range(dims)]).alias("sums"))
    out = centroids.copy()
    for r in totals.collect():  # at most k rows
        out[r.cluster] = [s // r.n for s in r.sums]
    return out


def assign(table: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(id, cluster, distance) of every vector in the blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema("id bigint, cluster int, distance bigint")
        for block in _each(batches):
            cluster, distance = block.nearest(centroids)
            yield pa.RecordBatch.from_arrays([block.ids, pa.array(cluster.astype(np.int32)), pa.array(distance)], schema=schema)
        release()

    return table.mapInArrow(run, "id bigint, cluster int, distance bigint")


def cluster_vectors(
    vectors: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    dims: int = DIMS,
    k: int = CENTROIDS,
    rounds: int = ROUNDS,
    seed: int = SEED,
) -> tuple[DataFrame, np.ndarray]:
    """(id, cluster, distance) of every vector that counts, written once, and the final centroids (k, dims)."""
    table = written(blocks(vectors, id_column, vector_column, dims), "centroid-blocks")
    centroids = first_centroids(vectors, id_column, vector_column, dims, k, seed)
    for _ in range(rounds if len(centroids) else 0):
        centroids = next_centroids(table, centroids)
    return written(assign(table, centroids), "centroid-clusters"), centroids


def digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def cluster_report(vectors: DataFrame) -> DataFrame:
    """Each vector with its cluster, distance, the inertia of the cluster and of all, and its centroid's digest."""
    assigned, centroids = cluster_vectors(vectors)
    inertia = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()  # k rows
    total = sum(int(r.s) for r in inertia)
    rows = [(r.cluster, int(r.s), total, digest(centroids[r.cluster])) for r in inertia]
    facts = vectors.sparkSession.createDataFrame(rows, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return assigned.withColumnRenamed("id", "vec_id").join(F.broadcast(facts), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def report_sql(dims: int = DIMS, k: int = CENTROIDS, rounds: int = ROUNDS, seed: int = SEED) -> str:
    """The report in DuckDB's SQL: distances as sums over (vector, centroid, dimension), one CTE a round."""
    nearest = """a{i} AS MATERIALIZED (
  SELECT rid, k, dist FROM (
    SELECT rid, k, sum((x.v - c.v) * (x.v - c.v)) AS dist FROM x JOIN c{i} c USING (d) GROUP BY rid, k)
  QUALIFY row_number() OVER (PARTITION BY rid ORDER BY dist, k) = 1)"""
    step = """c{j} AS MATERIALIZED (
  SELECT k, d, CAST((sum(v) - ((sum(v) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS v
  FROM a{i} JOIN x USING (rid) GROUP BY k, d
  UNION ALL SELECT k, d, v FROM c{i} WHERE k NOT IN (SELECT k FROM a{i}))"""
    parts = [
        f"""kept AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, embedding AS e,
         list_transform(embedding, lambda q: CAST(floor({SCALE} * CAST(q AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda q: q IS NULL OR isnan(q) OR isinf(q))) = 0)""",
        f"x AS MATERIALIZED (SELECT rid, unnest(range({dims})) AS d, unnest(v) AS v FROM kept)",
        f"""f AS (
  SELECT v, row_number() OVER (ORDER BY sha256('{seed}:' || coalesce(CAST(vec_id AS VARCHAR), '')), e) - 1 AS k
  FROM kept QUALIFY k < {k})""",
        f"c0 AS MATERIALIZED (SELECT k, unnest(range({dims})) AS d, unnest(v) AS v FROM f)",
    ]
    for i in range(rounds):
        parts += [nearest.format(i=i), step.format(i=i, j=i + 1)]
    parts.append(nearest.format(i=rounds))
    parts.append(f"h AS (SELECT k, sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY d)) AS s FROM c{rounds} GROUP BY k)")
    return "WITH " + ",\n".join(parts) + f"""
SELECT vec_id, CAST(k AS INTEGER) AS cluster, CAST(dist AS BIGINT) AS distance,
       CAST(sum(dist) OVER (PARTITION BY k) AS BIGINT) AS cluster_inertia,
       CAST(sum(dist) OVER () AS BIGINT) AS inertia, s AS centroid_sha256
FROM a{rounds} JOIN kept USING (rid) JOIN h USING (k)
"""
