"""End-to-end jobs on files, and the streaming versions."""

import gzip
import json

import pytest
from pyspark.sql import functions as F

from linecraft.plans.jobs import (
    EmptyInputError,
    application_events_job,
    log_analysis_job,
    log_tagging_job,
    word_count_job,
    word_count_with_report_job,
)
from linecraft.session import checkpoint_root
from linecraft.sources import object_store_options
from linecraft.streaming import start_parsed_log_stream, start_running_counts_stream

GOOD = 'h{i} - - [01/Aug/1995:00:00:{s:02d} -0400] "GET /p/{i} HTTP/1.0" 200 {i}'


def _log_lines(n_good, n_bad):
    return [GOOD.format(i=i, s=i % 60) for i in range(n_good)] + [f"junk {i}" for i in range(n_bad)]


def test_word_count_job(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("to be or\nnot to be\n")
    word_count_job(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    got = sorted(r.value for r in spark.read.text(str(tmp_path / "out")).collect())
    assert got == ["(be,2)", "(not,1)", "(or,1)", "(to,2)"]


def test_log_analysis_job(spark, tmp_path):
    with gzip.open(tmp_path / "access.log.gz", "wt") as f:
        f.write("\n".join(_log_lines(40, 9)) + "\n")
    counts = log_analysis_job(spark, str(tmp_path / "access.log.gz"), str(tmp_path / "out"),
                              rejects_path=str(tmp_path / "rej"))
    assert counts == {"total": 49, "failed": 9, "ok": 40}
    recs = spark.read.parquet(str(tmp_path / "out"))
    assert recs.count() == 40 and "request_time" in recs.columns
    assert spark.read.parquet(str(tmp_path / "rej")).where("reason = 'no_match'").count() == 9


def test_log_analysis_job_json_sink(spark, tmp_path):
    (tmp_path / "a.log").write_text("\n".join(_log_lines(3, 1)))
    log_analysis_job(spark, str(tmp_path / "a.log"), str(tmp_path / "out"), fmt="json")
    rows = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "out")).collect()]
    assert len(rows) == 3 and all(r["response_code"] == 200 for r in rows)


def test_log_analysis_job_empty_input_writes_nothing(spark, tmp_path):
    (tmp_path / "empty.log").write_text("")
    with pytest.raises(EmptyInputError, match="No Data found in RDD"):
        log_analysis_job(spark, str(tmp_path / "empty.log"), str(tmp_path / "out"))
    assert not (tmp_path / "out").exists()


def test_word_count_with_report_job(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for i in range(3):
        (tmp_path / "in" / f"{i}.txt").write_text("x y\n" * (i + 1))
    word_count_with_report_job(spark, str(tmp_path / "in"), str(tmp_path / "wc"), str(tmp_path / "rep"))
    reports = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "rep")).collect()]
    assert sum(r["row_count"] for r in reports) == 6
    assert all("executor_dirs" in r for r in reports)
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "wc")).collect()) == ["(x,6)", "(y,6)"]


def test_application_events_job(spark, tmp_path):
    (tmp_path / "logs").mkdir()
    (tmp_path / "logs" / "app-9").write_text(
        '{"Event":"SparkListenerApplicationStart","App ID":"app-9","Timestamp":10}\n'
        '{"Event":"SparkListenerJobStart","Job ID":1}\n'
        '{"Event":"SparkListenerApplicationEnd","Timestamp":20}\n'
    )
    application_events_job(spark, str(tmp_path / "logs"), str(tmp_path / "out"))
    got = sorted(tuple(r) for r in spark.read.json(str(tmp_path / "out")).select("app_id", "event", "time_ms").collect())
    assert got == [("app-9", "end", 20), ("app-9", "start", 10)]


def test_object_store_options():
    o = object_store_options("AK", "SK", "TOKEN")
    assert o["fs.s3a.access.key"] == "AK" and o["fs.s3a.session.token"] == "TOKEN"
    assert o["fs.s3a.aws.credentials.provider"].endswith("TemporaryAWSCredentialsProvider")
    assert "fs.s3a.session.token" not in object_store_options("AK", "SK")
    assert object_store_options("AK", "SK", fresh_file_system=True)["fs.s3a.impl.disable.cache"] == "true"


def test_per_read_options_reach_the_file_system(spark, tmp_path):
    """A viewfs mount table given only as read options must be used by the
    file system of that read (as object-store keys would be)."""
    from linecraft.sources import read_lines

    (tmp_path / "data").mkdir()
    (tmp_path / "data" / "x.txt").write_text("v1\nv2\n")
    opts = {"fs.viewfs.mounttable.lcmount.link./data": f"file://{tmp_path}/data"}
    df = read_lines(spark, "viewfs://lcmount/data/x.txt", options=opts)
    assert [r.value for r in df.collect()] == ["v1", "v2"]
    with pytest.raises(Exception):
        read_lines(spark, "viewfs://lcother/data/x.txt").collect()


def test_checkpoint_root_from_session(spark):
    assert checkpoint_root(spark)


def test_parsed_log_stream(spark, tmp_path):
    src = tmp_path / "incoming"
    src.mkdir()
    (src / "1.log").write_text("\n".join(_log_lines(5, 2)))
    q = start_parsed_log_stream(spark, str(src), str(tmp_path / "out"), available_now=True)
    q.awaitTermination(120)
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.where("parsed = 1").count() == 5
    assert out.where("parsed = 0 and reject_reason = 'no_match'").count() == 2  # rejects are kept
    (src / "2.log").write_text("\n".join(_log_lines(3, 1)))
    q = start_parsed_log_stream(spark, str(src), str(tmp_path / "out"), available_now=True)
    q.awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 11  # new file only


def test_running_word_counts_stream(spark, tmp_path):
    src = tmp_path / "incoming"
    src.mkdir()
    (src / "1.txt").write_text("a b a\n")
    out = str(tmp_path / "counts")
    ck = str(tmp_path / "ck")
    start_running_counts_stream(spark, str(src), out, checkpoint=ck, available_now=True).awaitTermination(120)
    (src / "2.txt").write_text("a c\n")
    start_running_counts_stream(spark, str(src), out, checkpoint=ck, available_now=True).awaitTermination(120)
    df = spark.read.parquet(out)
    latest = df.groupBy("word").agg(F.max_by("cnt", "batch_id").alias("cnt"))
    assert {r.word: r.cnt for r in latest.collect()} == {"a": 3, "b": 1, "c": 1}


def test_command_line_log_analysis(tmp_path):
    import os
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    (tmp_path / "a.log").write_text("\n".join(_log_lines(4, 2)) + "\n")
    out = subprocess.run(
        [sys.executable, "-m", "linecraft", "--master", "local[2]", "log-analysis",
         str(tmp_path / "a.log"), str(tmp_path / "out"), "--fmt", "json"],
        cwd=root, capture_output=True, text=True, timeout=600,
    )
    assert out.returncode == 0, out.stderr[-2000:]
    assert json.loads(out.stdout.strip().splitlines()[-1]) == {"total": 6, "failed": 2, "ok": 4}
    assert len(list((tmp_path / "out").glob("part-*"))) >= 1


def test_default_checkpoints_are_per_stream(spark, tmp_path):
    from linecraft.streaming.file_stream import _checkpoint

    a = _checkpoint(spark, "parsed-logs", None, "/in/a", "/out/a")
    b = _checkpoint(spark, "parsed-logs", None, "/in/b", "/out/a")
    assert a != b and a == _checkpoint(spark, "parsed-logs", None, "/in/a", "/out/a")
    assert a.startswith(checkpoint_root(spark))


def test_log_tagging_job_one_pass(spark, tmp_path):
    (tmp_path / "a.log").write_text("\n".join(_log_lines(30, 7)) + "\n")
    counts = log_tagging_job(spark, str(tmp_path / "a.log"), str(tmp_path / "tagged"))
    assert counts == {"total": 37, "failed": 7, "ok": 30}
    df = spark.read.parquet(str(tmp_path / "tagged"))
    assert df.where("parsed = 1").count() == 30
    assert {r.reject_reason for r in df.where("parsed = 0").collect()} == {"no_match"}
    assert sorted(p.name for p in (tmp_path / "tagged").iterdir() if p.is_dir()) == ["parsed=0", "parsed=1"]


def test_running_log_counts_stream(spark, tmp_path):
    src = tmp_path / "incoming"
    src.mkdir()
    out, ck = str(tmp_path / "counts"), str(tmp_path / "ck")
    (src / "1.log").write_text("\n".join(_log_lines(5, 2)))
    start_running_counts_stream(spark, str(src), out, kind="log_counts", checkpoint=ck,
                                available_now=True).awaitTermination(120)
    (src / "2.log").write_text("\n".join(_log_lines(3, 4)))
    start_running_counts_stream(spark, str(src), out, kind="log_counts", checkpoint=ck,
                                available_now=True).awaitTermination(120)
    latest = spark.read.parquet(out).orderBy(F.col("batch_id").desc()).first()
    assert (latest.total, latest.failed, latest.ok) == (14, 6, 8)
