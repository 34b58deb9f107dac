"""The plan properties the design relies on at scale, checked on the
registered queries (physical plans before execution)."""

import pytest

import __spark_entry__ as entry_mod
from conftest import SF_SMALL

Q = entry_mod.queries()


def _physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_word_count_combines_before_the_exchange(spark):
    plan = _physical(Q["word_count"](spark, SF_SMALL))
    assert "partial_count" in plan
    assert plan.count("hashpartitioning(word") == 1
    assert "ReadSchema: struct<text:string>" in plan  # doc_id pruned


@pytest.mark.parametrize("name", ["log_tagged", "log_parsed", "log_rejects", "log_counts", "log_content_size"])
def test_access_log_regex_runs_once_per_line(spark, name):
    plan = _optimized(Q[name](spark, SF_SMALL))
    assert plan.count("regexp_replace") == 1, name


def test_log_counts_is_one_global_aggregate(spark):
    plan = _physical(Q["log_counts"](spark, SF_SMALL))
    assert "SinglePartition" in plan and "partial_count" in plan


def test_app_events_reads_the_logs_once(spark):
    plan = _physical(Q["app_events"](spark, SF_SMALL))
    assert plan.count("FileScan parquet") == 1
    assert plan.count("hashpartitioning(__log") == 1


def test_partition_report_reads_no_column_and_does_not_shuffle_rows(spark):
    plan = _physical(Q["partition_report"](spark, SF_SMALL))
    assert "ReadSchema: struct<>" in plan
    assert "REPARTITION_BY_NUM" not in plan


def test_light_queries_skip_the_spread(spark):
    assert "REPARTITION_BY_NUM" not in _physical(Q["log_json"](spark, SF_SMALL))
