"""the run date and its partition value.

The daily job scores the partition of the day before the run date. The run
date is a parameter (default: today), so backfills and reruns use the same
code path.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

PARTITION_FORMAT = "yyyyMMdd"


def previous_day(run_date: Column | str | None = None) -> Column:
    """``yyyyMMdd`` of the day before ``run_date`` (a DATE column or 'yyyy-MM-dd')."""
    if run_date is None:
        day = F.current_date()
    elif isinstance(run_date, str):
        day = F.to_date(F.lit(run_date))
    else:
        day = run_date
    return F.date_format(F.date_sub(day, 1), PARTITION_FORMAT)


def previous_day_value(run_date: _dt.date | str | None = None) -> str:
    """The same as a Python string, for static partition specs and paths."""
    if run_date is None:
        day = _dt.datetime.now(_dt.timezone.utc).date()  # the session's zone
    elif isinstance(run_date, str):
        day = _dt.date.fromisoformat(run_date)
    else:
        day = run_date
    return (day - _dt.timedelta(days=1)).strftime("%Y%m%d")


