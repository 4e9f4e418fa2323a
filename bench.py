"""Benchmark the headline queries; prints one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Each query runs to completion through a ``noop`` sink (the whole plan
executes, nothing is collected). A warm-up on sf0.001 runs first, untimed.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


from datescore.operators import boosting as B  # noqa: E402
from datescore.operators import model as M  # noqa: E402
from datescore.operators import tuning as TU  # noqa: E402
from datescore.operators import sampling as S  # noqa: E402
from datescore.plans import catalog as C  # noqa: E402
from datescore.schema import FEATURES  # noqa: E402
from datescore.session import build_session  # noqa: E402
from datescore.sources import model_store  # noqa: E402
from datescore.sources.fixture import features_from_dir  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def features(spark, sf_dir):
    return features_from_dir(spark, sf_dir)


def train_gbt(spark, sf_dir):
    params = M.TreeParams(max_iter=5, max_depth=4, min_instances_per_node=1)
    M.train(features_from_dir(spark, sf_dir), params)
    return None


def train_boosted(spark, sf_dir):
    """5 second-order trees, depth 4, on every fixture row, cut points included."""
    B.train(features_from_dir(spark, sf_dir), B.BoostParams(rounds=5, max_depth=4, block=5))
    return None


def cv_two_settings(spark, sf_dir):
    folded = S.fold_assign(features_from_dir(spark, sf_dir))
    points = [TU.Point(2, 3, 0.1, 0.0, 1.0), TU.Point(3, 3, 0.1, 0.0, 1.0)]
    TU.cross_validate(folded, points, parallelism=2)
    return None


def store_repeated(model, times: int, path: str) -> str:
    """The model stored with its trees ``times`` times over: the cost of scoring with so many trees, without
    the hour that training them takes here."""
    n = M.gbt_stage(model).getNumTrees
    copies = F.explode(F.sequence(F.lit(0), F.lit(times - 1)))
    nodes = M.node_table(model).withColumn("copy", copies).withColumn("tree", F.col("tree") + n * F.col("copy")).drop("copy")
    return model_store.save_nodes(nodes, path, FEATURES, margin_scale=M.MLLIB_MARGIN_SCALE, fill=True)


class DailyJob:
    """W1 alone, as run every day: the stored feature table and the model exist
    (set up untimed); the timed part loads the model, scans yesterday's partition,
    scores it and replaces it in the result table."""

    def __init__(self, spark, sf_dir, trees: int = 0):
        from datescore.sources.feature_table import read_feature_table, write_feature_table
        from datescore.session import work_path

        f = features_from_dir(spark, sf_dir, training=True)
        self.source = read_feature_table(spark, write_feature_table(f.drop("label", "pre_days_median"), work_path(spark, "bench-features")))
        self.model = None
        if trees:
            params = M.TreeParams(max_iter=20, max_depth=7, min_instances_per_node=1)
            model = M.train(S.class_sample(f, 200), params)
            self.model = store_repeated(model, trees // 20, work_path(spark, "bench-model"))
        self.table = f"bench_w1_{trees}_trees"
        from datescore.sources import result_table

        result_table.drop_table(spark, self.table)
        result_table.create_result_table(spark, self.table, work_path(spark, "bench-results"))

    def __call__(self, spark, sf_dir):
        from datescore.plans import jobs

        model = model_store.load_index(self.model, 1500) if self.model else None
        jobs.daily_scoring(self.source, self.table, C.RUN_DATE, model=model).collect()
        return None


BENCH = {
    "features": features,
    "feature_extract": C.feature_extract,
    "score_pairs": C.score_pairs,
    "class_sample": C.class_sample,
    "holdout": C.holdout,
    "fold_assign": C.fold_assign,
    "auc_scores": C.auc_scores,
    "class_report": C.class_report,
    "confusion_matrix": C.confusion_matrix,
    "partition_audit": C.partition_audit,
    "result_overwrite": C.result_overwrite,
    "daily_scoring": C.daily_scoring,
    "train_gbt_5": train_gbt,
    "train_boosted_5": train_boosted,
    "cv_3fold_2settings": cv_two_settings,
}


def main() -> None:
    # A work folder of its own for this local run.
    folder = {"spark.checkpoint.dir": tempfile.mkdtemp(prefix="datescore-bench-")}
    spark = build_session(f"local[{CPUS}]", shuffle_partitions=CPUS, **folder)
    # Warm-up: JVM, codegen and Python workers.
    run(C.score_pairs(spark, "/root/testdata/sf0.001"))
    run(C.auc_scores(spark, "/root/testdata/sf0.001"))
    queries = dict(BENCH)
    queries["w1_day_ensemble"] = DailyJob(spark, SF_DIR)
    queries["w1_day_gbt20"] = DailyJob(spark, SF_DIR, trees=20)
    queries["w1_day_gbt1500_of_2000"] = DailyJob(spark, SF_DIR, trees=2000)
    times = {}
    for name, q in queries.items():
        t = time.perf_counter()
        out = q(spark, SF_DIR)
        if out is not None:
            run(out)
        times[name] = round(time.perf_counter() - t, 3)
    m = re.search(r"sf([0-9.]+)", SF_DIR)
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(m.group(1)) if m else SF_DIR,
                "cpus": CPUS,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
