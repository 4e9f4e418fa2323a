"""W1 driven by the arrival of new days in the feature table.

The reference runs the daily scoring job from a scheduler, once per day. In
Structured Streaming the same job becomes a file-source stream over the
day-partitioned feature table with ``trigger(availableNow=True)``: each run
processes exactly the days that appeared since the last run, recorded in the
stream's checkpoint under the shared folder.

Each micro-batch only tells *which* days changed (a small set). Those days
are then scored in full from the table and written with dynamic partition
overwrite, so the result for a day never depends on how its files were
split across micro-batches, and a replayed batch rewrites the same rows.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from datescore.operators import ensemble as E
from datescore.plans import jobs
from datescore.schema import EXTRACT_SCHEMA, PARTITION
from datescore.sources.feature_table import read_feature_table
from datescore.sources.result_table import overwrite_partitions_at


def score_days(
    spark: SparkSession,
    features_path: str,
    days: list[str],
    output_path: str,
    model: PipelineModel | None = None,
    ensemble: E.Ensemble | None = None,
    ntree_limit: int | None = 1500,
) -> None:
    """Score the given days of the feature table and replace them in the output."""
    if not days:
        return
    source = read_feature_table(spark, features_path).where(F.col(PARTITION).isin(*days))
    if model is not None:
        res = jobs.score_with_model(source, model, ntree_limit)
    else:
        res = jobs.score_with_ensemble(source, ensemble or E.FIXED_ENSEMBLE)
    overwrite_partitions_at(res, output_path)


def start(
    spark: SparkSession,
    features_path: str,
    output_path: str,
    checkpoint_path: str,
    model: PipelineModel | None = None,
    ensemble: E.Ensemble | None = None,
    ntree_limit: int | None = 1500,
    available_now: bool = True,
) -> StreamingQuery:
    """Start the stream; with ``available_now`` it processes what is there and stops."""
    stream = spark.readStream.schema(EXTRACT_SCHEMA).parquet(features_path)

    def on_batch(batch: DataFrame, _epoch: int) -> None:
        # Days present in the batch: at most one row per day reaches the driver.
        days = [r[0] for r in batch.select(PARTITION).distinct().collect()]
        if None in days:
            raise ValueError(f"rows without a day ({PARTITION} is null) in {features_path}: name their partition and rerun")
        score_days(spark, features_path, sorted(days), output_path, model, ensemble, ntree_limit)

    writer = stream.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint_path)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 hour")
    return writer.start()


def run_available(
    spark: SparkSession,
    features_path: str,
    output_path: str,
    checkpoint_path: str,
    **kw,
) -> DataFrame:
    """Process every new day once and return the output table."""
    q = start(spark, features_path, output_path, checkpoint_path, available_now=True, **kw)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return spark.read.schema("user_name STRING, dep_date DATE, q_ratio FLOAT, dt STRING").option(
        "basePath", output_path
    ).parquet(output_path)
