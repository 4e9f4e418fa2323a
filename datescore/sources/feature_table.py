"""The day-partitioned feature table and its one-partition scan.

The table is Parquet partitioned by ``dt`` (a 'yyyyMMdd' STRING). A scan of
one day puts ``dt = '...'`` on the partition column, so only that directory
is listed and read (``PartitionFilters`` in the plan), and the fixed select
list reaches the reader as ``ReadSchema``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession

from datescore.functions.dates import previous_day
from datescore.operators.prepare import partition_filter, project_extract
from datescore.schema import EXTRACT_SCHEMA, PARTITION, TRAINING_SCHEMA


def write_feature_table(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Store a feature frame as Parquet partitioned by ``dt``.

    ``REBALANCE`` clusters rows by ``dt`` so tasks write few files per day,
    and lets AQE split a day that is much larger than the others across
    several tasks (a plain ``repartition(dt)`` would write a hot day from one
    task) and merge small ones.
    """
    (
        df.hint("rebalance", PARTITION)
        .write.mode(mode)
        .partitionBy(PARTITION)
        .parquet(path)
    )
    return path


def read_feature_table(spark: SparkSession, path: str, training: bool = False) -> DataFrame:
    """The whole table with a fixed schema (``dt`` stays a STRING)."""
    schema = TRAINING_SCHEMA if training else EXTRACT_SCHEMA
    return spark.read.schema(schema).option("basePath", path).parquet(path)


def scan_partition(source: DataFrame, dt: str | Column | None = None) -> DataFrame:
    """S1 + P1 + P2: the 24 extract columns of one day (default: yesterday, F1)."""
    day = previous_day() if dt is None else dt
    return project_extract(partition_filter(source, day))
