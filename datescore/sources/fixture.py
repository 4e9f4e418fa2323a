"""Feature table derived from the ``events`` table.

The scoring job consumes a per-(user, candidate date, day) feature table that
upstream systems produce; none of that feature engineering is in scope. To
run every operator on real, growing data, this module derives a table with
the same 24 columns (+ ``pre_days_median`` and ``label`` for training) from
``events``. The formulas are ours and match FIXTURES.md §2.

Plan shape (designed for very large ``events``):

1. One scan, one shuffle. Each non-purchase event is a candidate row keyed by
   (user, search day, lead days). A purchase on day ``b`` for departure ``dep``
   makes label 1 for the candidates of the same user and ``dep`` searched on
   days ``b-7 .. b-1``: it is exploded into those 7 keys, so the label becomes
   part of the same aggregation instead of a range join. Partial aggregation
   runs before the exchange, so the shuffle carries at most one row per key
   per map task, whatever the event volume of a hot user.
2. Per-day and running per-user statistics are windows over the aggregated
   rows. They share one exchange on ``user_id``: the per-(user, day) window is
   satisfied by that partitioning. A user holds at most 15 candidate rows per
   day, so a partition of the window is bounded by the calendar, not by the
   number of events of that user.
3. Profile flags are a pure function of ``user_id`` (no join needed).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from datescore.schema import EXTRACT_COLUMNS, LABEL, MEDIAN

# Fixed values of the fixture (FIXTURES.md §2).
LEAD_DAYS_MODULUS = 15  # pre_days = floor(value) % 15
LABEL_HORIZON_DAYS = 7  # purchase within 1..7 days after the search
FRIDAY, SATURDAY = 5, 6  # ISO weekday numbers (Monday = 1)
FRIDAY_NIGHT_FROM_HOUR = 18  # hour >= 18
SATURDAY_MORNING_BEFORE_HOUR = 12  # hour < 12
PROFILE_ABSENT = (7, 3)  # users with user_id % 7 = 3 have no profile
STUDENT_MODULUS = 5  # is_student: user_id % 5 = 0
TRADER_MODULUS = 4  # is_trader: user_id % 4 = 0


def iso_weekday(c: Column) -> Column:
    """ISO day of week, Monday = 1 .. Sunday = 7."""
    return F.weekday(c) + 1


def _flag(cond: Column) -> Column:
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def _candidate_keys(events: DataFrame) -> DataFrame:
    """Aggregate events into one row per (user_id, sd, pre) with counts and label."""
    etype = F.col("event_type")
    is_buy = F.coalesce(etype == "purchase", F.lit(False))
    is_click = F.coalesce(etype == "click", F.lit(False))
    is_candidate = F.coalesce(etype != "purchase", F.lit(False))
    ts = F.col("ts")
    offsets = F.when(is_buy, F.sequence(F.lit(1), F.lit(LABEL_HORIZON_DAYS))).otherwise(F.array(F.lit(0)))
    rows = events.select(
        "user_id",
        # ts is TIMESTAMP_NTZ: the cast to DATE does not depend on a time zone.
        ts.cast("date").alias("sd0"),
        (F.floor("value").cast("int") % LEAD_DAYS_MODULUS).alias("pre0"),
        _flag(is_candidate).alias("cand"),
        _flag(is_candidate & ~is_click).alias("search_one"),
        _flag(is_click).alias("click"),
        _flag(is_click & (iso_weekday(ts) == FRIDAY) & (F.hour(ts) >= FRIDAY_NIGHT_FROM_HOUR)).alias("fri"),
        _flag(is_click & (iso_weekday(ts) == SATURDAY) & (F.hour(ts) < SATURDAY_MORNING_BEFORE_HOUR)).alias("sat"),
        _flag(is_buy).alias("buy"),
        F.explode(offsets).alias("k"),
    )
    # A purchase on day b for departure dep = b + p is keyed as the candidate
    # searched on day b - k for the same dep, whose lead time is p + k.
    keyed = rows.select(
        "user_id",
        F.date_sub("sd0", F.col("k")).alias("sd"),
        (F.col("pre0") + F.col("k")).alias("pre_days"),
        "cand",
        "search_one",
        "click",
        "fri",
        "sat",
        "buy",
    )
    return (
        keyed.groupBy("user_id", "sd", "pre_days")
        .agg(
            F.sum("cand").alias("n_cand"),
            F.sum("search_one").alias("search_single"),
            F.sum("click").alias("ota_single"),
            F.max("fri").alias("fri"),
            F.max("sat").alias("sat"),
            F.max("buy").alias("label"),
        )
        .where(F.col("n_cand") > 0)
    )


def build_features(events: DataFrame, training: bool = True) -> DataFrame:
    """Feature table from ``events``: 24 extract columns, plus median and label if ``training``."""
    g = _candidate_keys(events).withColumn("dep", F.date_add("sd", F.col("pre_days")))
    day = Window.partitionBy("user_id", "sd")
    history = (
        Window.partitionBy("user_id").orderBy("sd").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    weekend_dep = (iso_weekday(F.col("dep")) >= SATURDAY).cast("long")
    g = g.select(
        "*",
        # Running over all earlier days of the user, peers of the same day included.
        F.sum(weekend_dep).over(history).alias("cwk"),
        F.count(F.lit(1)).over(history).alias("cn"),
        F.count(F.lit(1)).over(day).alias("date_cnt"),
        F.max("pre_days").over(day).alias("pre_days_max"),
        F.min("pre_days").over(day).alias("pre_days_min"),
        F.avg("pre_days").over(day).alias("pre_days_avg"),
        F.median("pre_days").over(day).alias(MEDIAN),
        F.sum("search_single").over(day).alias("search_date_cnt"),
        F.sum("ota_single").over(day).alias("ota_date_cnt"),
    )
    uid = F.col("user_id")
    has_profile = uid % PROFILE_ABSENT[0] != PROFILE_ABSENT[1]
    dep_weekend = iso_weekday(F.col("dep")) >= SATURDAY
    out = g.select(
        F.concat(F.lit("u"), uid.cast("string")).alias("user_name"),
        F.col("dep").alias("dep_date_of_search"),
        "date_cnt",
        F.col("sd").alias("search_date"),
        "pre_days",
        "pre_days_max",
        "pre_days_min",
        "pre_days_avg",
        F.abs(F.col("pre_days") - F.col(MEDIAN)).alias("difference_between_dep_date_median"),
        (F.col("pre_days_max") - F.col("pre_days_min")).alias("dep_date_span"),
        "search_date_cnt",
        F.col("search_single").alias("search_date_single_cnt"),
        (F.col("search_single") / F.nullif(F.col("search_date_cnt"), F.lit(0))).alias("search_date_rate"),
        "ota_date_cnt",
        F.col("ota_single").alias("ota_date_single_cnt"),
        (F.col("ota_single") / F.nullif(F.col("ota_date_cnt"), F.lit(0))).alias("ota_date_rate"),
        _flag((F.col("search_single") > 0) & dep_weekend).alias("search_date_is_weekend"),
        _flag((F.col("ota_single") > 0) & dep_weekend).alias("ota_date_is_weekend"),
        F.col("fri").alias("ota_date_on_friday_night"),
        F.col("sat").alias("ota_date_on_saturday_morning"),
        (F.col("cwk") / F.col("cn")).alias("history_weekend_rate"),
        F.when(has_profile, _flag(uid % STUDENT_MODULUS == 0)).alias("is_student"),
        F.when(has_profile, _flag(uid % TRADER_MODULUS == 0)).alias("is_trader"),
        F.date_format("sd", "yyyyMMdd").alias("dt"),
        MEDIAN,
        LABEL,
    )
    if not training:
        out = out.select(*EXTRACT_COLUMNS)
    return out


def read_events(spark, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def features_from_dir(spark, sf_dir: str, training: bool = True) -> DataFrame:
    return build_features(read_events(spark, sf_dir), training=training)
