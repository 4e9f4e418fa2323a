"""Replace every missing value by 0.

``na.fill`` on numeric columns covers null and NaN. Pandas also fills text
columns with 0; ``strings=True`` does the same with the text "0".
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC)]


def fill_missing(df: DataFrame, value: int = 0, strings: bool = False, subset: list[str] | None = None) -> DataFrame:
    cols = subset if subset is not None else numeric_columns(df)
    out = df.na.fill(value, subset=cols) if cols else df
    if strings:
        text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
        if text:
            out = out.na.fill(str(value), subset=text)
    return out
