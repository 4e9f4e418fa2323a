"""Exact seeded sampling, holdout, split and folds."""

from __future__ import annotations

import hashlib

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from datescore.operators import sampling as S
from datescore.schema import KEY, LABEL

SCHEMA = "user_name string, dt string, dep_date_of_search string, label int"


def plain_hash(seed, *fields):
    """The order key restated: every field as length and text, a missing one as '-'."""
    parts = ["-" if f is None else f"{len(str(f))}:{f}" for f in fields]
    return hashlib.md5("|".join([str(seed), *parts]).encode()).hexdigest()


def test_sample_is_the_first_n_by_the_plain_hash(features01):
    fl = S.flag_class_sample(features01, 200, seeds={1: 1, 0: 1})
    rows = fl.select(*KEY, LABEL, "sampled").collect()
    assert len(rows) == 7561
    for cls in (0, 1):
        order = sorted((r for r in rows if r[LABEL] == cls), key=lambda r: plain_hash(1, *[r[k] for k in KEY]))
        assert [r.sampled for r in order] == [True] * 200 + [False] * (len(order) - 200)


def _with_null_keys(spark):
    """400 rows, 200 per class; each key field is missing in some, and two keys differ only by a separator."""
    rows = []
    for i in range(400):
        user = None if i % 10 == 0 else f"u{i}"
        day = None if i % 10 == 1 else "20240101"
        dep = None if i % 10 == 2 else f"2024-01-{i % 28 + 1:02d}"
        rows.append((user, day, dep, i % 2, i))
    rows[5] = ("a|1:b", "20240101", "2024-01-02", 1, 5)
    rows[7] = ("a", "1:b|20240101", "2024-01-02", 1, 7)
    return spark.createDataFrame(rows, SCHEMA + ", id int")


def _id_keyed(f, *args):
    """Keys must be unique for an exact order: the row number joins the key."""
    return f(*args, key=[*KEY, "id"])


def test_no_row_is_lost_with_null_keys(spark):
    df = _with_null_keys(spark)
    sample = _id_keyed(S.class_sample, df, 50)
    held = _id_keyed(S.holdout, df, 50)
    assert dict(sample.groupBy(LABEL).count().collect()) == {0: 50, 1: 50}
    assert sorted(r.id for r in sample.unionByName(held).collect()) == list(range(400))
    anti = S.holdout_anti_join(df, sample, key=[*KEY, "id"])
    assert sorted(r.id for r in anti.collect()) == sorted(r.id for r in held.collect())
    split = S.half_split(df, key=[*KEY, "id"]).collect()
    assert len(split) == 400 and sum(r.is_test for r in split) == 200
    folds = S.fold_assign(df, key=[*KEY, "id"]).collect()
    assert sorted(r.id for r in folds) == list(range(400))
    assert sorted([r.fold for r in folds if r.label == 1].count(k) for k in range(3)) == [66, 67, 67]


def test_null_labels_are_a_fold_group_of_their_own(spark):
    rows = [(f"u{i}", "20240101", "2024-01-02", None if i % 3 == 0 else i % 2) for i in range(90)]
    folds = S.fold_assign(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(folds) == 90
    assert sorted([r.fold for r in folds if r.label is None].count(k) for k in range(3)) == [10, 10, 10]


def test_separator_in_a_name_does_not_collide(spark):
    df = spark.createDataFrame([("a|1:b", "c", "d", 1), ("a", "1:b|1:c", "d", 1), ("a", "b", None, 1), ("a", None, "b", 1)], SCHEMA)
    assert df.select(S.class_order_hash()).distinct().count() == 4


def test_hot_copies_in_folds(spark):
    """A key that a third of the rows share: all rows stay, folds stay balanced, copies need not be in one task."""
    rows = [("hot", "20240101", "2024-01-02", 0)] * 25_000 + [(f"u{i}", "20240101", "2024-01-02", i % 2) for i in range(500)]
    folds = S.fold_assign(spark.createDataFrame(rows, SCHEMA))
    per = {(r.label, r.fold): r["count"] for r in folds.groupBy(LABEL, "fold").count().collect()}
    for cls, size in ((0, 25_250), (1, 250)):
        mine = [per[cls, k] for k in range(3)]
        assert sum(mine) == size and max(mine) - min(mine) <= 1
    ranked = S.rank_by_hash(spark.createDataFrame(rows[:25_010], SCHEMA), S.seeded_hash(1), [], "r")
    assert ranked.agg(F.min("r"), F.max("r"), F.countDistinct("r")).first() == (1, 25_010, 25_010)


def test_sample_holdout_disjoint_and_exact(features01):
    sample = S.class_sample(features01, 150)
    held = S.holdout(features01, 150)
    assert dict(sample.groupBy(LABEL).count().collect()) == {1: 150, 0: 150}
    assert sample.count() + held.count() == features01.count()
    assert sample.join(held, KEY, "inner").count() == 0
    anti = S.holdout_anti_join(features01, sample)
    assert anti.exceptAll(held).count() == 0 and held.exceptAll(anti).count() == 0


def test_too_few_rows_names_the_class(features01):
    with pytest.raises(Exception, match="label=1"):
        S.class_sample(features01, 5000).count()


def test_absent_class_fails(spark):
    df = spark.createDataFrame([("a", "20240101", "2024-01-02", 0)], "user_name string, dt string, dep_date_of_search string, label int")
    with pytest.raises(Exception, match="label=1"):
        S.class_sample(df, 1).count()


def test_other_labels_stay_in_holdout(spark):
    rows = [(f"u{i}", "20240101", f"2024-01-{i % 28 + 1:02d}", i % 3) for i in range(60)]
    df = spark.createDataFrame(rows, "user_name string, dt string, dep_date_of_search string, label int")
    held = S.holdout(df, 5)
    assert held.where("label = 2").count() == 20
    assert S.class_sample(df, 5).where("label = 2").count() == 0


def test_split_exact_and_folds_stratified(features01):
    sample = S.class_sample(features01, 101)
    split = S.half_split(sample)
    assert split.where("is_test").count() == 101  # ceil(202 * 0.5)
    folds = S.fold_assign(sample)
    counts = {(r.fold, r.label): r["count"] for r in folds.groupBy("fold", LABEL).count().collect()}
    assert sorted(counts.values()) == [33, 33, 34, 34, 34, 34]
    assert set(r.fold for r in folds.select("fold").distinct().collect()) == {0, 1, 2}


def test_independent_of_partitioning(features01):
    a = S.class_sample(features01, 77).select(*KEY)
    b = S.class_sample(features01.repartition(13), 77).select(*KEY)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_matches_single_window_ranking(features01):
    """The bucketed rank equals a plain row_number over the whole class."""
    from pyspark.sql import Window

    h = S.class_order_hash()
    ranked = features01.where(F.col(LABEL).isin(0, 1)).withColumn(
        "_r", F.row_number().over(Window.partitionBy(LABEL).orderBy(h))
    )
    plain = ranked.where("_r <= 123").select(*KEY)
    ours = S.class_sample(features01, 123).select(*KEY)
    assert plain.exceptAll(ours).count() == 0 and ours.exceptAll(plain).count() == 0


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(sizes=st.tuples(st.integers(1, 40), st.integers(1, 40)), n=st.integers(1, 40), parts=st.integers(1, 5))
def test_property_exact_disjoint(spark, sizes, n, parts):
    rows = [(f"u{c}_{i}", "20240101", "2024-01-02", c) for c in (0, 1) for i in range(sizes[c])]
    df = spark.createDataFrame(rows, "user_name string, dt string, dep_date_of_search string, label int").repartition(parts)
    if n > min(sizes):
        with pytest.raises(Exception):
            S.class_sample(df, n).count()
        return
    fl = S.flag_class_sample(df, n).collect()
    got = {}
    for r in fl:
        got.setdefault((r.label, r.sampled), 0)
        got[(r.label, r.sampled)] += 1
    assert got.get((0, True), 0) == n and got.get((1, True), 0) == n
    assert len(fl) == sum(sizes)


def test_hot_copies_outside_the_boundary(spark):
    """A key with many copies: exact counts, no single-task ranking of the copies."""
    rows = [("hot", "20240101", "2024-01-02", 0)] * 3000 + [
        (f"u{i}", "20240101", "2024-01-02", i % 2) for i in range(400)
    ]
    df = spark.createDataFrame(rows, "user_name string, dt string, dep_date_of_search string, label int")
    others = [r for r in set(rows) if r[3] == 0 and r[0] != "hot"]
    place = {s: sum(plain_hash(s, *r[:3]) < plain_hash(s, *rows[0][:3]) for r in others) for s in range(40)}
    before, after = (next(s for s, p in place.items() if test(p)) for test in (lambda p: p < 100, lambda p: p > 100))
    # 3000 copies cannot stand among the first 100, and a part of them would be an arbitrary choice.
    with pytest.raises(Exception, match="duplicate key"):
        S.flag_class_sample(df, 100, seeds={1: 1, 0: before}).collect()
    fl = S.flag_class_sample(df, 100, seeds={1: 1, 0: after})
    got = {(r.label, r.sampled): r["count"] for r in fl.groupBy(LABEL, "sampled").count().collect()}
    assert got == {(1, True): 100, (1, False): 100, (0, True): 100, (0, False): 3100}
    assert fl.where("user_name = 'hot' AND sampled").count() == 0


def test_duplicate_key_straddling_k_fails(spark):
    rows = [("dup", "20240101", "2024-01-02", 1)] * 5 + [(f"x{i}", "20240101", "2024-01-03", 0) for i in range(5)]
    df = spark.createDataFrame(rows, "user_name string, dt string, dep_date_of_search string, label int")
    with pytest.raises(Exception, match="duplicate key"):
        S.flag_class_sample(df, 3, seeds={1: 1, 0: 1}).where("label = 1").collect()


def test_events_are_scanned_once_in_all_executions(spark, tmpdir_path):
    """Counts reads over every execution of the query, those that ran before the result's plan included."""
    from conftest import SF01, scans_of
    from datescore.plans.catalog import QUERIES

    for name in ("class_sample", "holdout_anti_join", "fold_assign"):
        with scans_of(spark, "events.parquet") as scans:
            QUERIES[name](spark, SF01).collect()
        assert scans() == 1, name


def test_class_sample_reads_its_input_twice(spark, features01, monkeypatch):
    """Once for the counts, once for the rows; the boundary and the sample come from the rows found."""
    from conftest import scans_of
    from datescore.session import materialize

    monkeypatch.setattr(S, "HEX_DIGITS", 1)  # 16 buckets a class: rank 200 falls inside one
    table = materialize(features01, "scanned-table")
    with scans_of(spark, "scanned-table") as scans:
        sample = S.class_sample(table, 200).collect()
    assert len(sample) == 400 and scans() == 2


def test_sample_and_holdout_are_the_flagged_rows_and_the_others(spark):
    """Missing keys, labels outside the classes, and cuts between two buckets or at the last row."""
    df = _with_null_keys(spark).withColumn(LABEL, F.when(F.col("id") < 390, F.col(LABEL)).when(F.col("id") < 395, 7))
    n1 = df.where("label = 1").count()
    for n in (0, 1, 50, n1):
        sample, held = S.class_sample_and_holdout(df, n, key=[*KEY, "id"])
        flagged = S.flag_class_sample(df, n, key=[*KEY, "id"])
        assert sample.columns == held.columns == df.columns
        assert sorted(r.id for r in sample.collect()) == sorted(r.id for r in flagged.where("sampled").collect())
        assert sorted(r.id for r in held.collect()) == sorted(r.id for r in flagged.where("not sampled").collect())
        assert sample.count() == 2 * n and held.count() == 400 - 2 * n


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(sizes=st.tuples(st.integers(0, 50), st.integers(1, 50)), parts=st.integers(1, 4))
def test_property_folds_cover_all(spark, sizes, parts):
    rows = [(f"u{c}_{i}", "20240101", "2024-01-02", c) for c in (0, 1) for i in range(sizes[c])]
    df = spark.createDataFrame(rows, "user_name string, dt string, dep_date_of_search string, label int").repartition(parts)
    got = S.fold_assign(df).collect()
    assert len(got) == len(rows) and {(r.user_name, r.label) for r in got} == {(r[0], r[3]) for r in rows}
    for c in (0, 1):
        per = [sum(1 for r in got if r.label == c and r.fold == k) for k in range(3)]
        assert sum(per) == sizes[c] and max(per) - min(per) <= 1
