"""logistic link; F3: casts of searched hyper-parameters."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def logistic(margin: Column) -> Column:
    """Probability of class 1 from a boosted-tree margin: 1 / (1 + exp(-m))."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))


def as_score(p: Column) -> Column:
    """Scores are stored as 32-bit floats."""
    return p.cast("float")


def int_param(c: Column) -> Column:
    """Truncate toward zero, like Python ``int()`` on a float."""
    return c.cast("int")


def float_param(c: Column) -> Column:
    return c.cast("double")
