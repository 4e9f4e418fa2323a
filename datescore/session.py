"""Session settings and the shared work folder.

Jobs that must cut lineage or hand a table to a later step write under the
folder the cluster names in ``spark.checkpoint.dir``. That setting is read
from the session; where it is unset the warehouse holds the folder.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on. Time zone: the fixture's dates come from
# TIMESTAMP_NTZ, which is zone-free, but result files are written in UTC.
JOB_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Partition values such as dt=20240115 stay strings.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}


def build_session(
    master: str = "local[*]", shuffle_partitions: int = 8, driver_memory: str = "8g", **extra
) -> SparkSession:
    """A local session for tests and benchmarks (on a cluster, use the cluster's)."""
    builder = (
        SparkSession.builder.master(master)
        .appName("datescore")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for k, v in {**JOB_CONF, **extra}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared work folder: the session's checkpoint folder, else one in the warehouse.

    No machine-local temporary folder is made up: executors on other hosts
    would not see it. A cluster without ``spark.checkpoint.dir`` whose
    warehouse is a local path fails here.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        warehouse = spark.conf.get("spark.sql.warehouse.dir")
        on_one_host = re.fullmatch(r"local(\[.*\])?", sc.master)
        if not on_one_host and re.match(r"(file:|/)", warehouse):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        folder = f"{warehouse.rstrip('/')}/_datescore"
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


# Folders handed out by ``work_path`` in this application.
_made: list[str] = []


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique location under the shared folder for one job's output."""
    path = f"{checkpoint_root(spark)}/datescore-{name}-{uuid.uuid4().hex[:12]}"
    _made.append(path)
    return path


def materialize(df, name: str):
    """Write ``df`` once as Parquet under the shared folder and read it back.

    Cuts the lineage (a lost executor re-reads files instead of recomputing
    the upstream plan) and, unlike an RDD checkpoint, computes ``df`` once.
    """
    path = work_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


FILE_ROWS = 50_000  # rows of a training task


def materialize_packed(df, name: str):
    """``df`` written once, in as few files as its rows need (about ``FILE_ROWS`` a file).

    For rows that many small jobs read, as boosting does for each level of each
    tree. A sample is written by as many tasks as its source was read by, and each
    of its few rows' files would be a task of every later job.
    """
    table = materialize(df, name)
    files = max(1, -(-table.count() // FILE_ROWS))
    return materialize(table.coalesce(files), name) if files < len(table.inputFiles()) else table


def delete_path(spark: SparkSession, path: str) -> bool:
    """Delete a work folder that nothing reads any more."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if path in _made:
        _made.remove(path)
    return bool(target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True))


def scratch_mark() -> int:
    """How many work folders were made so far; ``clear_scratch`` goes back to here."""
    return len(_made)


def clear_scratch(spark: SparkSession, mark: int = 0) -> int:
    """Delete the work folders made since ``mark``; for the end of a job whose results are read or loaded.

    Frames that read these folders are no longer usable. Returns how many were deleted.
    """
    done = 0
    while len(_made) > mark:
        done += delete_path(spark, _made[-1])
    return done
