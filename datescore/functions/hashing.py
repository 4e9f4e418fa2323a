"""Seeded, partitioning-independent order keys.

``rand(seed)`` depends on how rows are split into partitions, so it is never
used for sampling. Rows are ordered by an md5 of the seed and the key fields
instead: the same seed gives the same order on any cluster and in DuckDB.

Every field enters as ``<length>:<text>`` and a missing one as ``-``: no key
field can make the hash null, and no two different keys share a text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from datescore.schema import KEY

SEPARATOR = "|"


def field_text(c: str | Column) -> Column:
    """A field as unambiguous, never null text."""
    text = (F.col(c) if isinstance(c, str) else c).cast("string")
    return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def fields_text(cols: list[str]) -> Column:
    """Several fields as one unambiguous, never null text (empty for no fields)."""
    return F.concat(F.lit(""), *[F.concat(F.lit(SEPARATOR), field_text(c)) for c in cols])


def seeded_hash(seed: int | str | Column, cols: list[str] | None = None, stream: str | None = None) -> Column:
    """md5 of '<seed>|<field>|...', or '<stream>|<seed>|<field>|...' when a ``stream`` is named.

    Operators that draw from the same seed use different streams so that their
    orders are independent (the class sample and the split both use seed 43).
    """
    seed_col = seed if isinstance(seed, Column) else F.lit(str(seed))
    head = [F.lit(stream + SEPARATOR), seed_col] if stream else [seed_col]
    return F.md5(F.concat(*head, fields_text(cols or KEY)))


def hash_bucket(h: Column, hex_digits: int) -> Column:
    """Leading hex digits of an md5 as an integer bucket in [0, 16**hex_digits)."""
    return F.conv(F.substring(h, 1, hex_digits), 16, 10).cast("int")
