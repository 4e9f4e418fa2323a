"""Sources and sinks: TSV, CSV, the partitioned feature and result tables."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from conftest import SF001
from datescore.functions.dates import previous_day, previous_day_value
from datescore.functions.fill import fill_missing
from datescore.schema import EXTRACT_SCHEMA, RESULT_SCHEMA
from datescore.sources import result_table, text
from datescore.sources.feature_table import read_feature_table, scan_partition, write_feature_table
from datescore.sources.fixture import features_from_dir


def test_previous_day(spark):
    assert previous_day_value("2024-01-16") == "20240115"
    assert previous_day_value("2024-03-01") == "20240229"
    assert spark.range(1).select(previous_day("2024-01-01")).first()[0] == "20231231"


def test_partition_scan_prunes(spark, tmpdir_path):
    f = features_from_dir(spark, SF001, training=False)
    path = write_feature_table(f, os.path.join(tmpdir_path, "features"))
    day = scan_partition(read_feature_table(spark, path), "20240115")
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan and "(dt#" in plan and "20240115" in plan
    assert day.count() == f.where(F.col("dt") == "20240115").count() > 0
    assert dict(day.dtypes)["dt"] == "string"


def test_tsv_null_nan_text(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "in.tsv")
    names = EXTRACT_SCHEMA.names
    line = {n: "1" for n in names}
    line.update(user_name="u1", dep_date_of_search="2024-01-02", search_date="2024-01-01", dt="20240101")
    rows = []
    for v in ("NaN", "NULL", ""):
        r = dict(line)
        r["search_date_rate"] = v
        r["is_student"] = "NULL"
        rows.append("\t".join(r[n] for n in names))
    os.makedirs(p)
    with open(os.path.join(p, "part-0.csv"), "w") as fh:
        fh.write("\t".join(names) + "\n" + "\n".join(rows) + "\n")
    df = text.read_tsv(spark, p, EXTRACT_SCHEMA)
    raw = [r.search_date_rate for r in df.collect()]
    assert sum(1 for x in raw if x is None) == 2 and any(x != x for x in raw if x is not None)
    filled = fill_missing(df).collect()
    assert all(r.search_date_rate == 0.0 and r.is_student == 0 for r in filled)
    assert all(r.user_name == "u1" for r in filled)


def test_string_fill_parity(spark):
    df = spark.createDataFrame([(None, None)], "s string, x double")
    assert tuple(fill_missing(df).first()) == (None, 0.0)
    assert tuple(fill_missing(df, strings=True).first()) == ("0", 0.0)


def test_tsv_roundtrip(spark, tmpdir_path):
    f = features_from_dir(spark, SF001, training=False).where(F.col("dt") == "20240110")
    back = text.read_tsv(spark, text.write_tsv(f, os.path.join(tmpdir_path, "x")), EXTRACT_SCHEMA)
    assert back.exceptAll(f).count() == 0 and f.exceptAll(back).count() == 0


def test_result_csv_small_scores(spark, tmpdir_path):
    df = spark.createDataFrame([("u", "2024-01-02", 0.00012345)], "user_name string, dep_date string, q_ratio double").select(
        "user_name", F.to_date("dep_date").alias("dep_date"), F.col("q_ratio").cast("float").alias("q_ratio")
    )
    back = text.read_result_csv(spark, text.write_result_csv(df, os.path.join(tmpdir_path, "r")), RESULT_SCHEMA)
    assert back.first().q_ratio == df.first().q_ratio


def _result(spark, n, dt_value, score):
    rows = [(f"u{i}", f"2024-01-{i % 20 + 1:02d}", score) for i in range(n)]
    return spark.createDataFrame(rows, "user_name string, dep_date string, q_ratio double").select(
        "user_name", F.to_date("dep_date").alias("dep_date"), F.col("q_ratio").cast("float").alias("q_ratio")
    )


def test_overwrite_one_partition_idempotent(spark, tmpdir_path):
    t = "test_results_a"
    result_table.drop_table(spark, t)
    result_table.create_result_table(spark, t, os.path.join(tmpdir_path, "t"))
    try:
        result_table.overwrite_partition(_result(spark, 5, "20240101", 0.1), t, "20240101")
        result_table.overwrite_partition(_result(spark, 7, "20240102", 0.2), t, "20240102")
        result_table.overwrite_partition(_result(spark, 3, "20240101", 0.3), t, "20240101")
        result_table.overwrite_partition(_result(spark, 3, "20240101", 0.3), t, "20240101")
        counts = dict(result_table.partition_counts(spark.table(t)).collect())
        assert counts == {"20240101": 3, "20240102": 7}
        latest = result_table.latest_partitions(spark, t, 1)
        assert [tuple(r) for r in latest.collect()] == [("20240102", 7)]
        # Only the latest days are read, as partition filters.
        assert "PartitionFilters: [isnotnull(dt" in latest._jdf.queryExecution().executedPlan().toString()
        result_table.drop_partition(spark, t, "20240102")
        assert dict(result_table.partition_counts(spark.table(t)).collect()) == {"20240101": 3}
        peek = result_table.peek(spark.table(t), order=["dt", "user_name", "dep_date"]).collect()
        assert [r.user_name for r in peek] == ["u0", "u1", "u2"]
    finally:
        result_table.drop_table(spark, t)
    assert not spark.catalog.tableExists(t)


def test_dynamic_overwrite_on_path(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "res")
    a = _result(spark, 4, "x", 0.1).withColumn("dt", F.lit("20240101"))
    b = _result(spark, 2, "x", 0.2).withColumn("dt", F.lit("20240102"))
    result_table.overwrite_partitions_at(a.unionByName(b), p)
    result_table.overwrite_partitions_at(_result(spark, 1, "x", 0.3).withColumn("dt", F.lit("20240101")), p)
    back = spark.read.option("basePath", p).parquet(p)
    assert dict(back.groupBy("dt").count().collect()) == {"20240101": 1, "20240102": 2}


def test_result_csv_plain_and_scientific_text(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "txt")
    os.makedirs(p)
    with open(os.path.join(p, "part-0.csv"), "w") as fh:
        fh.write("user_name,dep_date,q_ratio\nu1,2024-01-02,0.00012345\nu2,2024-01-03,1.2345E-4\n")
    vals = [r.q_ratio for r in text.read_result_csv(spark, p, RESULT_SCHEMA).collect()]
    assert vals[0] == vals[1] and abs(vals[0] - 0.00012345) < 1e-10


def _file(folder, name, text_):
    p = os.path.join(folder, name)
    os.makedirs(p)
    with open(os.path.join(p, "part-0.csv"), "w") as fh:
        fh.write(text_)
    return p


def test_columns_are_read_by_header_name(spark, tmpdir_path):
    names = list(reversed(EXTRACT_SCHEMA.names))
    line = {n: "1" for n in names}
    line.update(dep_date_of_search="2024-01-02", search_date="2024-01-01", dt="20240101", pre_days_max="9", pre_days_min="2")
    p = _file(tmpdir_path, "shuffled", "\t".join(names) + "\n" + "\t".join(line[n] for n in names) + "\n")
    r = text.read_tsv(spark, p, EXTRACT_SCHEMA).first()
    assert (r.pre_days_max, r.pre_days_min, r.dt) == (9, 2, "20240101")
    q = _file(tmpdir_path, "csv", "q_ratio,user_name,dep_date\n0.5,u1,2024-01-02\n")
    r = text.read_result_csv(spark, q, RESULT_SCHEMA).first()
    assert (r.user_name, str(r.dep_date), r.q_ratio) == ("u1", "2024-01-02", 0.5)


def test_missing_and_unknown_columns_fail(spark, tmpdir_path):
    import pytest

    missing = _file(tmpdir_path, "missing", "user_name,dep_date\nu1,2024-01-02\n")
    with pytest.raises(ValueError, match="missing columns .'q_ratio'"):
        text.read_result_csv(spark, missing, RESULT_SCHEMA)
    unknown = _file(tmpdir_path, "unknown", "user_name,dep_date,q_ratio,extra\nu1,2024-01-02,1,2\n")
    with pytest.raises(ValueError, match="unknown columns .'extra'"):
        text.read_result_csv(spark, unknown, RESULT_SCHEMA)


def test_result_dates_with_slashes_and_other_user_column(spark, tmpdir_path):
    import pytest

    p = _file(tmpdir_path, "slashes", "who,dep_date,q_ratio\nu1,2019/7/5,0.5\nu2,2019/12/31,0.25\nu3,2019-07-06,1E-3\nu4,,0.1\n")
    rows = text.read_result_csv(spark, p, RESULT_SCHEMA, {"who": "user_name"}).collect()
    assert {(r.user_name, str(r.dep_date)) for r in rows} == {
        ("u1", "2019-07-05"), ("u2", "2019-12-31"), ("u3", "2019-07-06"), ("u4", "None")
    }
    bad = _file(tmpdir_path, "bad", "user_name,dep_date,q_ratio\nu1,5 July,0.5\n")
    with pytest.raises(Exception, match="bad date"):
        text.read_result_csv(spark, bad, RESULT_SCHEMA).collect()


def test_peek_reads_no_more_than_asked(spark):
    df = spark.range(100).withColumn("dt", F.lit("20240101"))
    assert "Sort" not in result_table.peek(df)._jdf.queryExecution().executedPlan().toString()
    assert [r.id for r in result_table.peek(df, 3, order=["id"]).collect()] == [0, 1, 2]


def test_key_and_feature_projections(spark):
    import pytest

    from datescore.operators.prepare import feature_matrix, key_columns
    from datescore.schema import FEATURES, KEY

    f = features_from_dir(spark, SF001)
    assert key_columns(f, with_label=True).columns == [*KEY, "label"]
    assert feature_matrix(f).columns == FEATURES
    with pytest.raises(ValueError, match="missing columns"):
        feature_matrix(f.drop("is_trader"))


def test_hot_day_is_split_across_writers(spark, tmpdir_path):
    """A day with most of the rows is written by several tasks (REBALANCE on dt)."""
    import glob

    rows = spark.range(20000).select(
        F.when(F.col("id") % 10 == 0, F.concat(F.lit("202401"), F.lpad((F.col("id") % 9 + 10).cast("string"), 2, "0")))
        .otherwise(F.lit("20240101"))
        .alias("dt"),
        F.col("id").cast("string").alias("user_name"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"),
    )
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    old = spark.conf.get(key)
    spark.conf.set(key, "64k")
    try:
        path = write_feature_table(rows, os.path.join(tmpdir_path, "hot"))
    finally:
        spark.conf.set(key, old)
    hot_files = glob.glob(os.path.join(path, "dt=20240101", "*.parquet"))
    cold_files = glob.glob(os.path.join(path, "dt=20240110", "*.parquet"))
    assert len(hot_files) > 1 and len(cold_files) >= 1
    assert spark.read.parquet(path).count() == 20000


def _loads(location):
    folder = os.path.join(location, result_table.LOADS)
    return sorted(os.listdir(folder)) if os.path.isdir(folder) else []


def test_a_load_that_fails_leaves_the_day_readable(spark, tmpdir_path):
    """The job dies midway, after files were written: readers still see the old rows, also in a new catalog."""
    t, location = "t_atomic", os.path.join(tmpdir_path, "atomic")
    result_table.create_result_table(spark, t, location)
    try:
        result_table.overwrite_partition(_result(spark, 5, "20240101", 0.1), t, "20240101")
        begun = [f.removeprefix("file://") for f in spark.table(t).inputFiles()]
        boom = F.when(F.col("user_name") == "u90", F.raise_error(F.lit("midway"))).otherwise(F.lit(0.9)).cast("float")
        many = spark.range(100).repartition(4, "id").select(
            F.concat(F.lit("u"), "id").alias("user_name"), F.lit(None).cast("date").alias("dep_date"), F.lit(0).alias("x")
        )
        try:
            result_table.overwrite_partition(many.withColumn("q_ratio", boom), t, "20240101")
            raise AssertionError("the load should have failed")
        except Exception as e:
            assert "midway" in str(e)
        for _ in range(2):
            rows = spark.table(t).collect()
            assert len(rows) == 5 and {round(r.q_ratio, 5) for r in rows} == {0.1}
            spark.sql(f"DROP TABLE {t}")
            result_table.create_result_table(spark, t, location)
        # A reader that began before a load can finish; the load after that takes its files away.
        result_table.overwrite_partition(_result(spark, 7, "20240101", 0.2), t, "20240101")
        assert begun and all(map(os.path.exists, begun)) and spark.table(t).count() == 7
        result_table.overwrite_partition(_result(spark, 8, "20240101", 0.3), t, "20240101")
        assert not any(map(os.path.exists, begun)) and spark.table(t).count() == 8
        done = [d for d in _loads(location) if os.path.exists(os.path.join(location, result_table.LOADS, d, result_table.DONE))]
        assert len(done) == 2
        result_table.drop_partition(spark, t, "20240101")
        spark.sql(f"DROP TABLE {t}")
        result_table.create_result_table(spark, t, location)
        assert spark.table(t).count() == 0
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {t}")


def test_a_day_written_by_path_is_replaced_in_the_catalog(spark, tmpdir_path):
    t, location = "t_by_path", os.path.join(tmpdir_path, "bypath")
    both = _result(spark, 4, "20240101", 0.1).withColumn("dt", F.lit("20240101"))
    both = both.unionByName(_result(spark, 6, "20240102", 0.2).withColumn("dt", F.lit("20240102")))
    result_table.overwrite_partitions_at(both, location)
    result_table.create_result_table(spark, t, location)
    try:
        result_table.overwrite_partition(_result(spark, 9, "20240101", 0.5), t, "20240101")
        assert {r.dt: r["count"] for r in spark.table(t).groupBy("dt").count().collect()} == {"20240101": 9, "20240102": 6}
        spark.sql(f"DROP TABLE {t}")
        result_table.create_result_table(spark, t, location)  # a catalog that knew nothing finds the newest load
        assert {r.dt: r["count"] for r in spark.table(t).groupBy("dt").count().collect()} == {"20240101": 9, "20240102": 6}
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {t}")
