"""Column names, types and the fixed feature order.

The feature table holds one row per (user, candidate departure date, snapshot
day). Scoring drops the three key columns and the partition column and keeps
the 20 features below, in this order; training uses the same list (one list
for both, so train and serve never disagree on the inputs).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

USER = "user_name"
DEP_DATE = "dep_date_of_search"
SEARCH_DATE = "search_date"
PARTITION = "dt"
LABEL = "label"
MEDIAN = "pre_days_median"

# Row identity: unique per feature table.
KEY = [USER, PARTITION, DEP_DATE]

# The 20 model inputs in the order the model sees them.
FEATURES = [
    "date_cnt",
    "pre_days",
    "pre_days_max",
    "pre_days_min",
    "pre_days_avg",
    "difference_between_dep_date_median",
    "dep_date_span",
    "search_date_cnt",
    "search_date_single_cnt",
    "search_date_rate",
    "ota_date_cnt",
    "ota_date_single_cnt",
    "ota_date_rate",
    "search_date_is_weekend",
    "ota_date_is_weekend",
    "ota_date_on_friday_night",
    "ota_date_on_saturday_morning",
    "history_weekend_rate",
    "is_student",
    "is_trader",
]

# The extract's 24 columns in the order of the file.
EXTRACT_COLUMNS = [
    USER,
    DEP_DATE,
    "date_cnt",
    SEARCH_DATE,
    "pre_days",
    "pre_days_max",
    "pre_days_min",
    "pre_days_avg",
    "difference_between_dep_date_median",
    "dep_date_span",
    "search_date_cnt",
    "search_date_single_cnt",
    "search_date_rate",
    "ota_date_cnt",
    "ota_date_single_cnt",
    "ota_date_rate",
    "search_date_is_weekend",
    "ota_date_is_weekend",
    "ota_date_on_friday_night",
    "ota_date_on_saturday_morning",
    "history_weekend_rate",
    "is_student",
    "is_trader",
    PARTITION,
]

TRAINING_COLUMNS = [*EXTRACT_COLUMNS, MEDIAN, LABEL]

_FEATURE_TYPES = {
    "date_cnt": T.LongType(),
    "pre_days": T.IntegerType(),
    "pre_days_max": T.IntegerType(),
    "pre_days_min": T.IntegerType(),
    "pre_days_avg": T.DoubleType(),
    "difference_between_dep_date_median": T.DoubleType(),
    "dep_date_span": T.IntegerType(),
    "search_date_cnt": T.LongType(),
    "search_date_single_cnt": T.LongType(),
    "search_date_rate": T.DoubleType(),
    "ota_date_cnt": T.LongType(),
    "ota_date_single_cnt": T.LongType(),
    "ota_date_rate": T.DoubleType(),
    "search_date_is_weekend": T.IntegerType(),
    "ota_date_is_weekend": T.IntegerType(),
    "ota_date_on_friday_night": T.IntegerType(),
    "ota_date_on_saturday_morning": T.IntegerType(),
    "history_weekend_rate": T.DoubleType(),
    "is_student": T.IntegerType(),
    "is_trader": T.IntegerType(),
}

_KEY_TYPES = {
    USER: T.StringType(),
    DEP_DATE: T.DateType(),
    SEARCH_DATE: T.DateType(),
    PARTITION: T.StringType(),
    MEDIAN: T.DoubleType(),
    LABEL: T.IntegerType(),
}


def _struct(names: list[str]) -> T.StructType:
    types = {**_FEATURE_TYPES, **_KEY_TYPES}
    return T.StructType([T.StructField(n, types[n], True) for n in names])


EXTRACT_SCHEMA = _struct(EXTRACT_COLUMNS)
TRAINING_SCHEMA = _struct(TRAINING_COLUMNS)

# Result of scoring: user, departure date, float score; partitioned by dt.
RESULT_COLUMNS = [USER, "dep_date", "q_ratio"]
RESULT_SCHEMA = T.StructType(
    [
        T.StructField(USER, T.StringType(), True),
        T.StructField("dep_date", T.DateType(), True),
        T.StructField("q_ratio", T.FloatType(), True),
    ]
)


def require_columns(df: DataFrame, names: list[str]) -> None:
    """Fail like pandas does when a named column is absent (Spark's drop is silent)."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
