"""Partition report and application start/end events."""

import json
import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from linecraft import fixtures
from linecraft.operators import application_events, partition_report, report_json
from linecraft.sources import read_event_log_lines, read_table

from conftest import SF_SMALL

HERE = os.path.dirname(os.path.abspath(__file__))


def test_report_one_row_per_partition_including_empty(spark):
    df = spark.range(0, 10, numPartitions=4).where("id < 3")  # later partitions are empty
    rep = partition_report(df).collect()
    assert sorted(r.partition_id for r in rep) == [0, 1, 2, 3]
    assert sum(r.row_count for r in rep) == 3
    assert any(r.row_count == 0 for r in rep)
    assert all(r.attempt_number == 0 and r.host and r.user_dir for r in rep)
    assert partition_report(df).columns[:3] == ["partition_id", "attempt_number", "row_count"]


def test_report_reads_no_columns(spark):
    ev = read_table(spark, SF_SMALL, "events")
    plan = partition_report(ev)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<>" in plan
    assert partition_report(ev).agg(F.sum("row_count")).first()[0] == ev.count()


def test_report_json_keeps_nulls(spark):
    rep = partition_report(spark.range(0, 4, numPartitions=2))
    msgs = [json.loads(r.json) for r in report_json(rep).collect()]
    assert len(msgs) == 2
    for m in msgs:
        assert "executor_dirs" in m and "log_url_stderr" in m  # null in local mode, kept
        assert isinstance(m["created_at"], int) and m["row_count"] == 2


def test_record_json_null_field(spark):
    from linecraft.functions import record_json

    r = spark.range(1).select(record_json(F.lit(1).alias("a"), F.lit(None).cast("string").alias("b"))).first()
    assert r[0] == '{"a":1,"b":null}'


def test_app_events_from_rendered_lines(spark):
    ev = read_table(spark, SF_SMALL, "events").select("event_id")
    out = application_events(fixtures.event_log_lines(ev)).collect()
    n = ev.count()
    assert len(out) == sum(1 for i in range(n) if i % 4 in (0, 2))
    for r in out:
        assert r.message == f"Application {r.event} event captured : time - {r.time_ms}"
        assert r.app_id.startswith("app-")


def test_app_events_end_takes_start_id(spark):
    lines = spark.createDataFrame(
        [
            ("/x/application_1_0001_1", '{"Event":"SparkListenerApplicationStart","App ID":"application_1_0001","Timestamp":5}'),
            ("/x/application_1_0001_1", '{"Event":"SparkListenerApplicationEnd","Timestamp":9}'),
            ("/x/app-2.zstd.inprogress", '{"Event":"SparkListenerApplicationEnd","Timestamp":3}'),
            ("/x/app-2.zstd.inprogress", '{"Event":"SparkListener\\u0041pplicationStart","Timestamp":1}'),
            ("/x/app-3", "not json"),
            ("/x/app-3", '{"Event":"SparkListenerJobStart"}'),
        ],
        "path string, value string",
    )
    got = sorted(tuple(r) for r in application_events(lines).select("app_id", "event", "time_ms").collect())
    assert got == [
        ("app-2", "end", 3),
        ("app-2", "start", 1),
        ("application_1_0001", "end", 9),
        ("application_1_0001", "start", 5),
    ]


@pytest.fixture(scope="module")
def event_log_dir(tmp_path_factory):
    d = tmp_path_factory.mktemp("eventlogs")
    env = dict(os.environ)
    subprocess.run([sys.executable, os.path.join(HERE, "helpers", "make_event_logs.py"), str(d)],
                   check=True, env=env, stdout=subprocess.DEVNULL, stderr=subprocess.DEVNULL, timeout=600)
    return str(d)


def test_real_event_logs(spark, event_log_dir):
    lines = read_event_log_lines(spark, event_log_dir)
    events = application_events(lines).collect()
    by_app = {}
    for r in events:
        by_app.setdefault(r.app_id, {})[r.event] = r.time_ms
    assert len(by_app) == 3
    for app, ev in by_app.items():
        assert set(ev) == {"start", "end"} and ev["start"] <= ev["end"], app


def test_results_survive_a_failed_task():
    """A task that dies once is re-run; the word count is exact and the
    report shows the retry in attempt_number instead of sending twice."""
    out = subprocess.run([sys.executable, os.path.join(HERE, "helpers", "retry_job.py")],
                         capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    res = json.loads(out.stdout.strip().splitlines()[-1])
    assert res["counts"] == {**{f"w{k}": sum(1 for i in range(1000) if i % 7 == k) for k in range(7)}, "x": 1000}
    by_part = {r["partition_id"]: r for r in res["report"]}
    assert sorted(by_part) == [0, 1, 2, 3]
    assert by_part[1]["attempt_number"] == 1 and by_part[0]["attempt_number"] == 0
    assert sum(r["row_count"] for r in res["report"]) == 1000
