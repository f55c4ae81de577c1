import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(ROOT, "tools"))


@pytest.fixture(scope="session")
def event_log(tmp_path_factory):
    return str(tmp_path_factory.mktemp("events"))


@pytest.fixture(scope="session")
def spark(event_log):
    from gridmart.session import get_session
    s = get_session("gridmart-tests", master="local[4]", extra={
        "spark.eventLog.enabled": "true",
        "spark.eventLog.dir": f"file://{event_log}",
        "spark.eventLog.compress": "false",
        "spark.eventLog.rolling.enabled": "false",
        "spark.sql.shuffle.partitions": "4",
        "spark.default.parallelism": "4",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
    })
    s.sparkContext.setLogLevel("ERROR")
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="gridmart-ckpt-"))
    yield s
    s.stop()


@pytest.fixture
def scans(spark, event_log):
    """Called after some work: the file scans of that work, by the event log."""
    import scan_report
    bus = spark.sparkContext._jsc.sc().listenerBus()
    bus.waitUntilEmpty()
    start = scan_report.sizes(event_log)

    def since():
        bus.waitUntilEmpty()
        return scan_report.scans(event_log, start)
    return since


@pytest.fixture
def scratch(tmp_path):
    return str(tmp_path)
