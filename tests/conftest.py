from __future__ import annotations

import contextlib
import json
import os
import sys
import tempfile
from pathlib import Path

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
# Python workers import the package too (only numpy/pandas UDF closures need it
# not, but tests may use helpers): make it importable there as well.
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")

EVENTS = tempfile.mkdtemp(prefix="datescore-test-events-")
SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from datescore.session import JOB_CONF

    builder = (
        SparkSession.builder.master("local[*]")
        .appName("datescore-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="datescore-test-warehouse-"))
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.dir", "file://" + EVENTS)
        .config("spark.eventLog.buffer.kb", "1k")
        .config("spark.eventLog.compress", "false")
        .config("spark.eventLog.rolling.enabled", "false")
    )
    for k, v in JOB_CONF.items():
        builder = builder.config(k, v)
    s = builder.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    # Tests set their own shared folder only where the session names none.
    if not s.sparkContext.getCheckpointDir() and not s.conf.get("spark.checkpoint.dir", None):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="datescore-test-ckpt-"))
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def features01(spark):
    from datescore.sources.fixture import features_from_dir

    return features_from_dir(spark, SF01)


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="datescore-test-")


@contextlib.contextmanager
def scans_of(spark, name: str):
    """Counts the tasks' stages that read ``name`` in the block, from the event log: all executions count."""
    bus = spark.sparkContext._jsc.sc().listenerBus()
    bus.waitUntilEmpty(30_000)
    path = next(Path(EVENTS).glob(f"{spark.sparkContext.applicationId}*"))
    start = path.stat().st_size

    def scans() -> int:
        bus.waitUntilEmpty(30_000)
        nodes, read = set(), set()
        with path.open() as log:
            log.seek(start)
            for line in log:
                event = json.loads(line)
                if "sparkPlanInfo" in event:
                    todo = [event["sparkPlanInfo"]]
                    while todo:
                        node = todo.pop()
                        todo += node["children"]
                        if name in json.dumps(node.get("metadata", {})) and node["nodeName"].startswith("Scan"):
                            nodes |= {(m["accumulatorId"], m["name"]) for m in node["metrics"]}
                elif event["Event"] == "SparkListenerStageCompleted":
                    read |= {a["ID"] for a in event["Stage Info"]["Accumulables"]}
        # One scan node has one counter of output rows; a node that no stage ran was reused or dropped.
        return len({i for i, m in nodes if m == "number of output rows" and i in read})

    yield scans


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
