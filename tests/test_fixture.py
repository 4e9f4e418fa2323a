"""The events-derived feature table reproduces FIXTURES.md §3 in Spark."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import SF001, SF01
from datescore.schema import EXTRACT_COLUMNS, FEATURES, KEY
from datescore.sources.fixture import build_features, features_from_dir

EXPECTED = {
    SF001: dict(rows=757, label=97, users=15, days=30, null_student=102, null_ota=353, null_search=53,
                hwr=196.359378, diff=1703, avg=5257, fri=15, sat=9, date_cnt=1945),
    SF01: dict(rows=7561, label=913, users=150, days=30, null_student=1045, null_ota=3639, null_search=500,
               hwr=2076.42662, diff=17201, avg=50196, fri=68, sat=138, date_cnt=19535),
}


@pytest.mark.parametrize("sf_dir", [SF001, SF01])
def test_checksums(spark, sf_dir):
    f = features_from_dir(spark, sf_dir)
    isnull = lambda c: F.sum(F.col(c).isNull().cast("int"))
    r = f.agg(
        F.count(F.lit(1)).alias("rows"),
        F.countDistinct(*KEY).alias("keys"),
        F.sum("label").alias("label"),
        F.countDistinct("user_name").alias("users"),
        F.countDistinct("dt").alias("days"),
        isnull("is_student").alias("null_student"),
        isnull("ota_date_rate").alias("null_ota"),
        isnull("search_date_rate").alias("null_search"),
        F.round(F.sum("history_weekend_rate"), 6).alias("hwr"),
        F.sum("difference_between_dep_date_median").alias("diff"),
        F.round(F.sum("pre_days_avg")).alias("avg"),
        F.sum("ota_date_on_friday_night").alias("fri"),
        F.sum("ota_date_on_saturday_morning").alias("sat"),
        F.sum("date_cnt").alias("date_cnt"),
    ).first().asDict()
    exp = EXPECTED[sf_dir]
    assert r["keys"] == r["rows"] == exp["rows"]
    for k, v in exp.items():
        assert r[k] == pytest.approx(v), k


def test_one_partition(spark):
    f = features_from_dir(spark, SF01)
    r = f.where(F.col("dt") == "20240115").agg(F.count(F.lit(1)), F.sum("label")).first()
    assert tuple(r) == (239, 26)


def test_schema(spark):
    f = features_from_dir(spark, SF001, training=False)
    assert f.columns == EXTRACT_COLUMNS
    assert len(FEATURES) == 20
    types = dict(f.dtypes)
    assert types["dt"] == "string" and types["dep_date_of_search"] == "date"
    assert types["date_cnt"] == "bigint" and types["pre_days"] == "int"


def test_plan_two_exchanges_after_partial_aggregation(spark):
    """One shuffle of partially aggregated events, one on user_id for the windows."""
    f = features_from_dir(spark, SF001)
    plan = f._jdf.queryExecution().executedPlan().toString()
    f.write.format("noop").mode("overwrite").save()
    assert plan.count("Exchange hashpartitioning") == 2
    assert "hashpartitioning(user_id" in plan
    assert "partial_sum" in f._jdf.queryExecution().optimizedPlan().toString() or "HashAggregate" in plan


def test_label_horizon(spark):
    """A purchase labels candidates of the same dep searched 1..7 days before."""
    rows = [
        # user, ts, type, value -> day 2024-01-10, lead 3 -> dep 01-13
        (1, "2024-01-10 10:00:00", "view", 3.5),
        # purchase on 01-12 for dep 01-13 (lead 1): within (sd, sd+7]
        (1, "2024-01-12 09:00:00", "purchase", 1.2),
        # candidate on 01-12 itself for the same dep: purchase not strictly after
        (1, "2024-01-12 08:00:00", "click", 1.0),
        # candidate 01-01 dep 01-13 (lead 12): purchase 11 days later, outside
        (1, "2024-01-01 08:00:00", "view", 12.0),
    ]
    ev = spark.createDataFrame(rows, "user_id long, ts string, event_type string, value double").select(
        "user_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "event_type", "value"
    )
    got = {(r.search_date.isoformat(), r.label) for r in build_features(ev).collect()}
    assert got == {("2024-01-10", 1), ("2024-01-12", 0), ("2024-01-01", 0)}


def test_hot_user_collapses_before_the_shuffle(spark):
    """A user with 20x copies of their events: same keys, counts x20, bounded window rows."""
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    hot = ev.where(F.col("user_id") == 0)
    copies = hot
    for _ in range(19):
        copies = copies.unionByName(hot)
    skewed = ev.where(F.col("user_id") != 0).unionByName(copies)
    base = {(r.dt, r.dep_date_of_search): r for r in build_features(ev).where("user_name = 'u0'").collect()}
    got = {(r.dt, r.dep_date_of_search): r for r in build_features(skewed).where("user_name = 'u0'").collect()}
    assert got.keys() == base.keys()
    assert len(got) <= 15 * 31  # window partition of the user: days x lead times
    for k, r in got.items():
        b = base[k]
        assert r.search_date_single_cnt == 20 * b.search_date_single_cnt
        assert r.ota_date_single_cnt == 20 * b.ota_date_single_cnt
        assert r.label == b.label and r.date_cnt == b.date_cnt
        assert r.history_weekend_rate == b.history_weekend_rate
