"""Jobs that read once and whose outputs appear together."""

import json
import os
import subprocess
import sys
import threading
from collections import Counter

import pytest
from pyspark.sql import functions as F

from linecraft.operators import count_words, partition_report, report_json
from linecraft.operators.partition_report import report_marks, report_of_marks, report_of_unread
from linecraft.operators.words import count_words_and_marks
from linecraft.plans import jobs
from linecraft.sinks import files

HELPER = os.path.join(os.path.dirname(__file__), "helpers", "scan_count.py")


def _measured(work, what):
    (work / "events").mkdir()
    out = subprocess.run([sys.executable, HELPER, str(work), what], capture_output=True, text=True, timeout=300)
    assert out.returncode == 0, out.stderr[-2000:]
    return json.loads(out.stdout.strip().splitlines()[-1])


def test_word_count_with_report_reads_its_input_once(tmp_path):
    (tmp_path / "in").mkdir()
    for i in range(6):
        (tmp_path / "in" / f"{i}.txt").write_text("some words  here\n" * 4000)
    got = _measured(tmp_path, "words")
    reports = [json.loads(x) for f in (tmp_path / "report").glob("*.txt") for x in f.read_text().splitlines()]
    # the lines once, and the counted words and marks
    assert 24_000 <= got["read"] < 24_000 + 4 * len(reports) + 20
    assert sum(r["row_count"] for r in reports) == 24_000 and len(reports) >= 6
    assert all(r["host"] and r["user_dir"] and r["created_at"] > 1_600_000_000_000 for r in reports)


def test_rejects_write_no_raw_line_of_a_record(tmp_path):
    (tmp_path / "in").mkdir()
    lines = ['h%d - - [01/Aug/1995:00:00:01 -0400] "GET /p/%s HTTP/1.0" 200 5' % (i, os.urandom(60).hex()) for i in range(5000)]
    (tmp_path / "in" / "a.log").write_text("\n".join([*lines, "junk"]) + "\n")
    got = _measured(tmp_path, "logs")
    final = sum(p.stat().st_size for d in ("records", "rejects") for p in (tmp_path / d).glob("*.parquet"))
    # the endpoints twice (once on the way), not three times
    assert final > 400_000
    assert got["written"] < 2.3 * final


@pytest.mark.parametrize("count_rows", [True, False])
def test_marks_tell_what_the_report_tells(spark, count_rows):
    lines = spark.range(0, 100, numPartitions=5).select(F.concat(F.lit("a b  {} "), F.col("id") % 7).alias("line")).where("id % 100 < 70")
    counted = count_words_and_marks(lines, "line", report_marks(count_rows))
    words = counted.where("not startswith(word, ' ')")
    assert sorted(map(tuple, words.collect())) == sorted(map(tuple, count_words(lines).collect()))
    got = report_of_marks(counted.where("startswith(word, ' ')"), count_rows)
    want = partition_report(lines, count_rows)
    same = [c for c in want.columns if c not in ("created_at", "attempt_number")]
    told = got.unionByName(report_of_unread(lines, [4], count_rows))
    read = {r["partition_id"]: tuple(r) for r in want.select(same).collect()}
    for r in told.select(same).collect():
        assert tuple(r) == read.pop(r["partition_id"])
    # partition 3 keeps no row either: rows 60 to 69 are its first ten
    assert set(read) <= {3}
    assert got.columns == want.columns


def test_marks_need_no_python(spark):
    lines = spark.range(10).select(F.lit("a b").alias("line"))
    plan = count_words_and_marks(lines, "line", report_marks())._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_report_job_has_empty_partitions_and_no_leftovers(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for i in range(4):
        (tmp_path / "in" / f"{i}.txt").write_text("x y\n" * i)
    (tmp_path / "in" / "blank.txt").write_text("\n \n")
    jobs.word_count_with_report_job(spark, str(tmp_path / "in"), str(tmp_path / "wc"), str(tmp_path / "rep"))
    reports = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "rep")).collect()]
    lines = spark.read.text(str(tmp_path / "in"))
    want = [json.loads(r.json) for r in report_json(partition_report(lines)).collect()]
    key = lambda r: (r["partition_id"], r["row_count"], tuple(sorted(r)))
    assert sorted(map(key, reports)) == sorted(map(key, want))
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "wc")).collect()) == ["(,1)", "(x,6)", "(y,6)"]
    assert sorted(os.listdir(tmp_path)) == ["in", "rep", "wc"]
    assert (tmp_path / "wc" / "_SUCCESS").exists() and (tmp_path / "rep" / "_SUCCESS").exists()


def test_report_job_on_an_input_without_lines(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "none.txt").write_text("")
    jobs.word_count_with_report_job(spark, str(tmp_path / "in"), str(tmp_path / "wc"), str(tmp_path / "rep"))
    assert spark.read.schema("value string").text(str(tmp_path / "wc")).count() == 0
    n = partition_report(spark.read.text(str(tmp_path / "in"))).count()
    assert spark.read.schema("value string").text(str(tmp_path / "rep")).count() == n


@pytest.mark.parametrize("mode", ["overwrite", "append"])
def test_report_job_modes(spark, tmp_path, mode):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("x y\n")
    for _ in range(2):
        jobs.word_count_with_report_job(spark, str(tmp_path / "in"), str(tmp_path / "wc"), str(tmp_path / "rep"), mode=mode)
    times = 2 if mode == "append" else 1
    got = Counter(r.value for r in spark.read.text(str(tmp_path / "wc")).collect())
    assert got == {"(x,1)": times, "(y,1)": times}
    assert spark.read.text(str(tmp_path / "rep")).count() == times
    assert sorted(os.listdir(tmp_path)) == ["in", "rep", "wc"]


@pytest.mark.parametrize("failing", [1, 2])
def test_a_failed_write_leaves_neither_output(spark, tmp_path, monkeypatch, failing):
    (tmp_path / "a.log").write_text('h - - [01/Aug/1995:00:00:01 -0400] "GET /p HTTP/1.0" 200 5\njunk\n')
    true, calls = jobs.write_records, []

    def write(*args, **kwargs):
        calls.append(1)
        if len(calls) == failing:
            raise OSError("disk gone")
        true(*args, **kwargs)

    monkeypatch.setattr(jobs, "write_records", write)
    with pytest.raises(OSError, match="disk gone"):
        jobs.log_analysis_job(spark, str(tmp_path / "a.log"), str(tmp_path / "out"), rejects_path=str(tmp_path / "rej"))
    assert os.listdir(tmp_path) == ["a.log"]


def test_publish_takes_back_what_it_moved(spark, tmp_path):
    for name in ("new1", "new2", "out1", "out2"):
        (tmp_path / name).mkdir()
        (tmp_path / name / "part").write_text(name)
    moves = [(str(tmp_path / "new1"), str(tmp_path / "out1")), (str(tmp_path / "gone"), str(tmp_path / "out2"))]
    with pytest.raises(Exception):  # noqa: B017 - whatever the file system raises
        files.publish(spark, moves, "overwrite")
    assert (tmp_path / "out1" / "part").read_text() == "out1" and (tmp_path / "out2" / "part").read_text() == "out2"
    assert (tmp_path / "new1" / "part").read_text() == "new1"
    with pytest.raises(FileExistsError):
        files.publish(spark, moves[:1], "errorifexists")
    files.publish(spark, [moves[0], (str(tmp_path / "new2"), str(tmp_path / "deep" / "er"))], "overwrite")
    assert (tmp_path / "out1" / "part").read_text() == "new1" and (tmp_path / "deep" / "er" / "part").read_text() == "new2"
    assert not [x for x in os.listdir(tmp_path) if "old" in x]


def test_outputs_inside_each_other_are_refused(spark, tmp_path):
    out = str(tmp_path / "out")
    for pair in ([out, out + "/rejects"], [out + "/a/b", out], [out, out + "/"], [out, f"file://{out}/x"]):
        with pytest.raises(ValueError, match="different folders"):
            files.check_targets(spark, pair, "overwrite")
    files.check_targets(spark, [out, out + "put"], "overwrite")


def test_shuffle_width_is_the_jobs_own(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text(" ".join(f"w{i}" for i in range(500)) + "\n")
    seen = []
    stop = threading.Event()

    def watch():
        while not stop.is_set():
            seen.append(spark.conf.get("spark.sql.shuffle.partitions"))

    t = threading.Thread(target=watch)
    t.start()
    try:
        jobs.word_count_job(spark, str(tmp_path / "in"), str(tmp_path / "out"), shuffle_partitions=3)
    finally:
        stop.set()
        t.join()
    assert set(seen) == {"8"}
    assert spark.read.text(str(tmp_path / "out")).count() == 500
    assert jobs._with_width(spark, 3).conf.get("spark.sql.session.timeZone") == "UTC"
