"""W1 on a stream of new days: each run scores exactly the new days, reruns are idempotent."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from conftest import SF001
from datescore.plans import jobs
from datescore.sources.feature_table import write_feature_table
from datescore.sources.fixture import features_from_dir
from datescore.streaming import daily


def test_stream_scores_new_days(spark, tmpdir_path):
    f = features_from_dir(spark, SF001, training=False)
    src = os.path.join(tmpdir_path, "features")
    out = os.path.join(tmpdir_path, "out")
    ckpt = os.path.join(tmpdir_path, "ckpt")
    first = f.where(F.col("dt") <= "20240110")
    write_feature_table(first, src, mode="append")
    res = daily.run_available(spark, src, out, ckpt)
    assert res.count() == first.count()
    # A new day arrives: only it is scored; earlier days keep their rows.
    write_feature_table(f.where(F.col("dt") == "20240111"), src, mode="append")
    res = daily.run_available(spark, src, out, ckpt)
    expect = jobs.score_with_ensemble(f.where(F.col("dt") <= "20240111"))
    assert res.count() == expect.count()
    assert res.exceptAll(expect.select(*res.columns)).count() == 0
    # Nothing new: a rerun changes nothing.
    res2 = daily.run_available(spark, src, out, ckpt)
    assert res2.count() == expect.count()
