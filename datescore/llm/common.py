"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The characters of the class [\x20\x09-\x0D] of the result contracts.
WHITE = " \t\n\x0b\x0c\r"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def parallelism(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: Ranges of a sorted order for each shuffle partition: several small ones even out what hashing deals to a task.
RANGES = 4


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def tokenizer_bytes(path: str) -> bytes:
    """A vocabulary file read once on the driver (a fixed file of a few MB), to be broadcast.

    Executors then need no copy of the file.
    """
    with open(path, "rb") as f:
        return f.read()


def tokenizer_path(name: str) -> str:
    """Default place of the public vocabulary files; every operator takes another path."""
    import public_tokenizers

    return public_tokenizers.path(name)


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = 1 << 19) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that ``column`` holds at most ``limit`` bytes of text in each piece.

    A single longer text makes a piece of its own: memory is bounded by
    ``limit`` plus the longest text, whatever the batch size of the session.
    """
    for batch in batches:
        n = batch.num_rows
        if n == 0:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0)
        ends = np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < n:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop
    release()


def release() -> None:
    """At the end of a task, give freed memory back: Python workers live on and serve all stages."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


TEXT_ROWS = 1_000  # texts are long: rows of them in one batch sent to Python


def to_python(df: DataFrame) -> DataFrame:
    """``df`` as it is; rows that hold texts go to Python in batches of at most TEXT_ROWS."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(conf.get(key))
    if now <= 0 or now > TEXT_ROWS:
        conf.set(key, str(TEXT_ROWS))
    return df


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts of a batch, null as empty."""
    return [t or "" for t in batch.column(batch.schema.get_field_index(column)).to_pylist()]


def keep_rows(docs: DataFrame, keep: Callable[[list[str]], list[bool]]) -> DataFrame:
    """The rows of ``docs`` whose texts (null as empty) ``keep`` says to keep, with all their columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            yield batch.filter(pa.array(keep(texts_of(batch)), pa.bool_()))

    return to_python(docs).mapInArrow(run, docs.schema)


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


_ARROW = {
    "bigint": pa.int64(),
    "int": pa.int32(),
    "double": pa.float64(),
    "boolean": pa.bool_(),
    "string": pa.string(),
    "binary": pa.binary(),
}


def arrow_schema(ddl: str) -> pa.Schema:
    """Arrow form of a flat schema; usable in tasks, where there is no session to parse DDL."""
    return pa.schema([(name, _ARROW[kind]) for name, kind in (f.split() for f in ddl.split(","))])


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared folder (see ``datescore.session``)."""
    from datescore.session import work_path

    return work_path(spark, name)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once under the shared folder and read back: cuts lineage, survives lost executors."""
    from datescore.session import materialize

    return materialize(df, name)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or ``name`` with underscores in front if a column of ``df`` is called that."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


# --- ranks without a single-task window -------------------------------------------


def ranked(rows: DataFrame, group: str, weight: str, order: list[str], sub: str, name: str) -> tuple[DataFrame, DataFrame]:
    """Rank of each row in its ``group``, counted in ``weight`` units, and the offsets behind it.

    ``group`` has a fixed number of values and ``sub`` a fixed number of
    sub-buckets of each (by a hash), so the offset table is bounded and is
    broadcast; a window partition is one sub-bucket. Returns ``rows`` with the
    column ``name`` = units before the row, and the table (group, total).
    """
    from pyspark.sql import Window

    counts = rows.groupBy(group, sub).agg(F.sum(weight).alias("_n"))
    before = Window.partitionBy(group).orderBy(sub).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(group, sub, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    totals = counts.groupBy(group).agg(F.sum("_n").alias("total"))
    inside = Window.partitionBy(group, sub).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    out = (
        rows.join(F.broadcast(offsets), [group, sub])
        .withColumn(name, F.col("_before") + F.coalesce(F.sum(weight).over(inside), F.lit(0)))
        .drop("_before")
    )
    return out, totals


def repeat_rows(rows: DataFrame, copies: str, first: str, block: int = 10_000) -> DataFrame:
    """Each row ``copies`` times, with ``first`` counting up from its value.

    A row with very many copies (one row repeated through a third of the
    table) is first split into blocks, dealt out, and only then repeated.
    """
    small = rows.where(F.col(copies) == 1)
    many = rows.where(F.col(copies) > 1)
    blocks = (
        many.withColumn("_at", F.explode(F.sequence(F.lit(0).cast("long"), F.col(copies) - 1, F.lit(block).cast("long"))))
        .repartition(F.col("_at"), F.col(first))
        .withColumn("_i", F.explode(F.sequence(F.col("_at"), F.least(F.col("_at") + block, F.col(copies)) - 1)))
        .withColumn(first, F.col(first) + F.col("_i"))
        .drop("_at", "_i")
    )
    return small.unionByName(blocks)

