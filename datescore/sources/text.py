"""Delimited text sources and sinks.

Stages of one job hand frames to each other in memory; these exist for
interchange with systems that expect files. Columns are read by the names in
the header, whatever their order; an unknown or missing name is an error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

NULL_TEXT = "NULL"  # how the warehouse CLI prints a missing value

# The date formats of result files.
DATE_FORMATS = ("yyyy-MM-dd", "yyyy/M/d")


def write_tsv(df: DataFrame, path: str) -> str:
    """Header TSV, unprefixed column names, missing values as ``NULL``."""
    (
        df.write.mode("overwrite")
        .option("sep", "\t")
        .option("header", True)
        .option("nullValue", NULL_TEXT)
        .option("dateFormat", "yyyy-MM-dd")
        .csv(path)
    )
    return path


def _header_schema(
    spark: SparkSession, path: str, schema: T.StructType, sep: str, names: dict[str, str] | None
) -> T.StructType:
    """``schema``'s fields in the order of the file's header, under the header's names."""
    header = spark.read.option("header", True).option("sep", sep).csv(path).columns
    ours = [(names or {}).get(c, c) for c in header]
    unknown = [h for h, c in zip(header, ours) if c not in schema.names]
    missing = [c for c in schema.names if c not in ours]
    if unknown or missing or len(set(ours)) != len(ours):
        raise ValueError(f"header of {path}: unknown columns {unknown}, missing columns {missing}, read {header}")
    return T.StructType([T.StructField(h, schema[c].dataType, True) for h, c in zip(header, ours)])


def _read(spark: SparkSession, path: str, schema: T.StructType, sep: str, names: dict[str, str] | None = None, **options) -> DataFrame:
    """Typed read by header; with ``enforceSchema`` off Spark checks the header of every file."""
    in_file = _header_schema(spark, path, schema, sep, names)
    reader = spark.read.schema(in_file).option("sep", sep).option("header", True).option("enforceSchema", False)
    frame = reader.options(mode="FAILFAST", **options).csv(path)
    return frame.toDF(*[(names or {}).get(c, c) for c in frame.columns]).select(*schema.names)


def read_tsv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """S3: header TSV with an explicit schema; ``NULL``, empty and ``NaN`` read as missing/NaN.

    No inference: types are fixed, and a malformed value fails the read.
    """
    return _read(spark, path, schema, "\t", nullValue=NULL_TEXT, nanValue="NaN", dateFormat="yyyy-MM-dd")


def write_result_csv(df: DataFrame, path: str, date_format: str = DATE_FORMATS[0]) -> str:
    """Comma-separated result with a header and no index column.

    Written as a directory of part files (one per task); no single-file
    coalesce, which would funnel all rows through one task.
    """
    df.write.mode("overwrite").option("header", True).option("dateFormat", date_format).csv(path)
    return path


def _date(text: Column) -> Column:
    """A date in any of DATE_FORMATS; other text fails the read, naming it."""
    parsed = F.coalesce(*[F.try_to_timestamp(text, F.lit(f)).cast("date") for f in DATE_FORMATS])
    wrong = F.raise_error(F.concat(F.lit("bad date in result file: "), text)).cast("date")
    return F.when(text.isNull(), F.lit(None).cast("date")).when(parsed.isNull(), wrong).otherwise(parsed)


def read_result_csv(spark: SparkSession, path: str, schema: T.StructType, names: dict[str, str] | None = None) -> DataFrame:
    """A result file by header name; ``names`` maps the file's column names to ours."""
    dates = [f.name for f in schema if isinstance(f.dataType, T.DateType)]
    raw = T.StructType([T.StructField(f.name, T.StringType() if f.name in dates else f.dataType) for f in schema])
    frame = _read(spark, path, raw, ",", names)
    return frame.select(*[_date(F.col(c)).alias(c) if c in dates else F.col(c) for c in schema.names])
