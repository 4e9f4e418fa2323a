"""Projections and row-level expressions.

Every function returns a DataFrame; keys always travel in the same row as
the values derived from them (no positional zips).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from datescore.functions.link import as_score
from datescore.schema import DEP_DATE, EXTRACT_COLUMNS, FEATURES, KEY, LABEL, PARTITION, USER, require_columns


def project_extract(df: DataFrame) -> DataFrame:
    """The 24 extract columns in extract order."""
    require_columns(df, EXTRACT_COLUMNS)
    return df.select(*EXTRACT_COLUMNS)


def partition_filter(df: DataFrame, dt: str | Column) -> DataFrame:
    """Rows of one snapshot day, compared as strings (``dt`` is 'yyyyMMdd')."""
    value = dt if isinstance(dt, Column) else F.lit(str(dt))
    return df.where(F.col(PARTITION) == value)


def feature_matrix(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """The 20 model inputs (plus ``keep`` columns that travel along).

    One list for scoring and training. A missing feature is an error.
    """
    require_columns(df, FEATURES + (keep or []))
    return df.select(*(keep or []), *FEATURES)


def key_columns(df: DataFrame, with_label: bool = False) -> DataFrame:
    """P5: the row key (and label)."""
    cols = KEY + ([LABEL] if with_label else [])
    require_columns(df, cols)
    return df.select(*cols)


def class_rows(df: DataFrame, label: int) -> DataFrame:
    """Rows of one class; rows with other labels go to neither class."""
    return df.where(F.col(LABEL) == F.lit(label))


def result_rows(df: DataFrame, score: str = "score", extra: list[str] | None = None) -> DataFrame:
    """User, departure date renamed, float score; fixed column order.

    ``extra`` columns (e.g. ``dt``) follow the three result columns.
    """
    return df.select(
        F.col(USER),
        F.col(DEP_DATE).alias("dep_date"),
        as_score(F.col(score)).alias("q_ratio"),
        *(extra or []),
    )


def threshold(score: Column, t: float = 0.5, inclusive: bool = False) -> Column:
    """P10 (strict, ``>``) and P11 (inclusive, ``>=``) hard labels as INT."""
    above = score >= F.lit(t) if inclusive else score > F.lit(t)
    return F.when(above, F.lit(1)).otherwise(F.lit(0))


def label_prediction_pairs(df: DataFrame, score: str = "score", t: float = 0.5, inclusive: bool = True) -> DataFrame:
    """Truth and prediction of one row side by side, with a literal id."""
    return df.select(
        F.col(LABEL).alias("true_label"),
        threshold(F.col(score), t, inclusive).alias("prediction_label"),
        F.lit(1).alias("id"),
    )


def check_unique_key(df: DataFrame, key: list[str] | None = None) -> None:
    """Fail when a key occurs twice, naming it.

    A distributed aggregation; at most one offending key reaches the driver.
    """
    key = key or KEY
    dup = df.groupBy(*key).count().where(F.col("count") > 1).limit(1).collect()
    if dup:
        raise ValueError(f"duplicate key {dict(zip(key, dup[0][: len(key)]))}")
