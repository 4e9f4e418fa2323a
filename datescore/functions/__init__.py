"""Scalar column functions (JVM-side expressions only)."""

from datescore.functions.dates import previous_day, previous_day_value
from datescore.functions.fill import fill_missing
from datescore.functions.hashing import hash_bucket, seeded_hash
from datescore.functions.link import as_score, float_param, int_param, logistic

__all__ = [
    "as_score",
    "fill_missing",
    "float_param",
    "hash_bucket",
    "int_param",
    "logistic",
    "previous_day",
    "previous_day_value",
    "seeded_hash",
]
