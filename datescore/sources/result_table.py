"""The day-partitioned result table (S5-S8) and its audit queries (A1, L1, L2).

A Parquet datasource table partitioned by ``dt``. Loading a day replaces
exactly that partition: other days are kept and a rerun of the same day is
idempotent. The day is written to a folder of its own (``_loads/<dt>-<number>``
under the table's location, hidden from readers) and then the catalog's
partition is pointed there, in one step: a load that fails leaves the old rows
readable, and no reader sees a half-written day. The folder that was replaced
stays until the next load of the day, for readers that have begun with it.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from datescore.schema import PARTITION, RESULT_COLUMNS, USER

LOADS = "_loads"  # of days, under the table's location
DONE = "_SUCCESS"  # in the folder of a finished load
TABLE_COMMENT = "Scores of (user, candidate date) pairs, one partition per scored day"
COLUMN_COMMENTS = {
    USER: "who the candidate belongs to",
    "dep_date": "candidate date",
    "q_ratio": "probability of class 1, between 0 and 1",
    PARTITION: "scored day of the feature table as yyyyMMdd",
}


def _check_name(name: str) -> str:
    parts = name.split(".")
    if not all(p.replace("_", "").isalnum() for p in parts):
        raise ValueError(f"bad table name {name!r}")
    return name


def create_result_table(spark: SparkSession, table: str, location: str | None = None) -> str:
    """Create the table if absent (commented, partitioned by ``dt``)."""
    c = COLUMN_COMMENTS
    where = ""
    if location:
        _mkdirs(spark, location)
        where = f" LOCATION '{location}'"
    spark.sql(
        f"""
        CREATE TABLE IF NOT EXISTS {_check_name(table)} (
          {USER} STRING COMMENT '{c[USER]}',
          dep_date DATE COMMENT '{c["dep_date"]}',
          q_ratio FLOAT COMMENT '{c["q_ratio"]}',
          {PARTITION} STRING COMMENT '{c[PARTITION]}'
        )
        USING parquet
        PARTITIONED BY ({PARTITION})
        COMMENT '{TABLE_COMMENT}'{where}
        """
    )
    if location:
        # Days already stored at the location (written by earlier runs) become
        # visible partitions, also when the catalog does not persist.
        spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")
        for dt, folders in _loads(spark, location).items():
            if LOADS in folders[-1]:
                _point(spark, table, dt, folders[-1])
    return table


def _hadoop(spark: SparkSession, path: str):
    """The folder as a Hadoop path and its file system (any scheme)."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _loads(spark: SparkSession, location: str, dt: str = "*") -> dict[str, list[str]]:
    """The finished loads of each day, oldest first (a few folder names a day; no data is read).

    The oldest may be a plain ``dt=`` folder that was written by path.
    """
    _, fs = _hadoop(spark, location)
    out: dict[str, list[str]] = {}
    for status in fs.globStatus(_hadoop(spark, f"{location}/{PARTITION}={dt}")[0]) or []:
        path = status.getPath()
        out[path.getName().partition("=")[2]] = [path.toString()]
    found = fs.globStatus(_hadoop(spark, f"{location}/{LOADS}/{dt}-*/{DONE}")[0]) or []
    for folder in sorted(status.getPath().getParent().toString() for status in found):
        day = folder.rpartition("/")[2].partition("-")[0]
        out.setdefault(day, []).append(folder)
    return out


def _delete(spark: SparkSession, folders: list[str]) -> None:
    for folder in folders:
        path, fs = _hadoop(spark, folder)
        fs.delete(path, True)


def _point(spark: SparkSession, table: str, dt: str, folder: str) -> None:
    """The switch: readers that begin from now on see ``folder`` as the day."""
    spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION ({PARTITION}='{dt}') LOCATION '{folder}'")
    spark.sql(f"ALTER TABLE {table} PARTITION ({PARTITION}='{dt}') SET LOCATION '{folder}'")
    spark.catalog.refreshTable(table)


def table_location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {_check_name(table)}").where("col_name = 'Location'").collect()
    return rows[0]["data_type"]


def _mkdirs(spark: SparkSession, location: str) -> None:
    """Create the table folder on its file system (any Hadoop scheme) if absent."""
    path, fs = _hadoop(spark, location)
    fs.mkdirs(path)


def overwrite_partition(result: DataFrame, table: str, dt: str) -> None:
    """Replace partition ``dt`` of ``table`` with ``result`` (user, dep_date, q_ratio), at once or not at all."""
    spark = result.sparkSession
    if not dt.isdigit():
        raise ValueError(f"bad partition value {dt!r}")
    location = table_location(spark, table)
    before = _loads(spark, location, dt).get(dt, [])
    folder = f"{location}/{LOADS}/{dt}-{time.time_ns():020d}"
    types = {"dep_date": "date", "q_ratio": "float"}
    columns = [F.col(c).cast(types.get(c, "string")).alias(c) for c in RESULT_COLUMNS]
    result.select(*columns).write.parquet(folder)
    done, fs = _hadoop(spark, f"{folder}/{DONE}")
    fs.create(done, True).close()
    _point(spark, table, dt, folder)
    _delete(spark, before[:-1])  # the one just replaced may still be read


def load_csv_into_partition(
    spark: SparkSession, csv_path: str, table: str, dt: str, user_column: str | None = None
) -> None:
    """S5 from a file: replace partition ``dt`` with the rows of a result CSV.

    The counterpart of loading a local result file into one partition: the
    header CSV is read by column name, with dates as ``yyyy-MM-dd`` or
    ``yyyy/M/d``, and inserted with static-partition overwrite. ``user_column``
    names the user column where the file calls it otherwise.
    """
    from datescore.schema import RESULT_SCHEMA
    from datescore.sources.text import read_result_csv

    names = {user_column: USER} if user_column else None
    overwrite_partition(read_result_csv(spark, csv_path, RESULT_SCHEMA, names), table, dt)


def overwrite_partitions_at(result_with_dt: DataFrame, path: str) -> None:
    """S5 on a path: replace only the days present in the frame (dynamic mode)."""
    (
        result_with_dt.select(*RESULT_COLUMNS, PARTITION)
        .hint("rebalance", PARTITION)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(PARTITION)
        .parquet(path)
    )


def drop_partition(spark: SparkSession, table: str, dt: str) -> None:
    """The day leaves the catalog, then its files go."""
    if not dt.isdigit():
        raise ValueError(f"bad partition value {dt!r}")
    folders = _loads(spark, table_location(spark, table), dt).get(dt, [])
    spark.sql(f"ALTER TABLE {_check_name(table)} DROP IF EXISTS PARTITION ({PARTITION}='{dt}')")
    _delete(spark, folders)


def drop_table(spark: SparkSession, table: str) -> None:
    """S8."""
    spark.sql(f"DROP TABLE IF EXISTS {_check_name(table)}")


def partition_counts(table_df: DataFrame) -> DataFrame:
    """A1: rows per partition (partial and final aggregation)."""
    return table_df.groupBy(PARTITION).agg(F.count(F.lit(1)).alias("count"))


def partition_days(spark: SparkSession, table: str) -> list[str]:
    """The days of the table, latest first, from the catalog (one entry per day; no data is read)."""
    rows = spark.sql(f"SHOW PARTITIONS {_check_name(table)}").collect()
    return sorted((r[0].partition("=")[2] for r in rows), reverse=True)


def latest_partitions(spark: SparkSession, table: str, n: int = 5) -> DataFrame:
    """A1 + L1: the ``n`` latest partitions with their row counts; only these are scanned.

    A day whose partition holds no row is not counted, as in a grouped count.
    """
    rows = spark.table(_check_name(table)).where(F.col(PARTITION).isin(partition_days(spark, table)[:n]))
    return partition_counts(rows).orderBy(F.desc(PARTITION))


def peek(table_df: DataFrame, n: int = 5, order: list[str] | None = None) -> DataFrame:
    """L2: a few rows: any (read from the first files only) or, on request, the first by ``order``."""
    return (table_df.orderBy(*order) if order else table_df).limit(n)
