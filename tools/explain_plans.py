"""Write PLANS.md: the physical plans of the main paths (sf0.01 inputs).

Usage: python tools/explain_plans.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from datescore.operators import metrics as MT  # noqa: E402
from datescore.operators import model as M  # noqa: E402
from datescore.operators import sampling as S  # noqa: E402
from datescore.plans import catalog as C  # noqa: E402
from datescore.plans import jobs  # noqa: E402
from datescore.session import build_session  # noqa: E402
from datescore.sources.feature_table import read_feature_table, scan_partition, write_feature_table  # noqa: E402
from datescore.sources.fixture import features_from_dir  # noqa: E402


def plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", **{"spark.checkpoint.dir": tempfile.mkdtemp(prefix="datescore-plans-")})
    f = features_from_dir(spark, sf_dir)
    stored = read_feature_table(
        spark, write_feature_table(f.drop("label", "pre_days_median"), tempfile.mkdtemp(prefix="plans-") + "/f")
    )
    day = scan_partition(stored, "20240115")
    model = M.train(S.class_sample(f, 100), M.TreeParams(max_iter=3, max_depth=3, min_instances_per_node=1))
    sections = [
        ("Feature table from events: two exchanges, partial aggregation first", f),
        ("W1, fixed ensemble: one stage, partition filter at the scan, CASE code", jobs.score_with_ensemble(day)),
        ("W1, trained GBT (first 1500 trees): one stage", jobs.score_with_model(day, model, 1500)),
        ("D1 class sample (after status and boundary decisions are written): broadcast joins only", S.class_sample(f, 200)),
        ("D3 folds: exchange on (group, hash bucket, hash, part)", S.fold_assign(S.class_sample(f, 200))),
        ("A9 input: score histogram (partial aggregation per score)", MT.score_histogram(C._scored(spark, sf_dir))),
    ]
    print("# Physical plans\n")
    print(f"Generated by `python tools/explain_plans.py {sf_dir}` (physical plans as planned; AQE may still coalesce partitions or switch joins at run time).\n")
    for title, df in sections:
        print(f"## {title}\n\n```\n{plan(df)}```\n")
    spark.stop()


if __name__ == "__main__":
    main()
