"""The queries the driver checks, each over whole tables of a data directory.

Every query reads the driver's parquet tables (``documents`` for text,
``events`` rendered into log lines for the log operators) and returns a
DataFrame with aliased columns that match the DuckDB oracle of the same name.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixtures
from ..functions.records import record_json
from ..operators.access_log import access_log_counts, parsed_records, rejected_lines, tag_access_log
from ..operators.layout import widen
from ..operators.lifecycle import application_events
from ..operators.partition_report import partition_report, report_json
from ..operators.words import tokenize, word_count, word_count_text
from ..session import new_folder
from ..sinks.files import remove_folder, write_text
from ..sources.text import lines_of, read_lines, read_table
from .jobs import EmptyInputError, log_analysis_job, word_count_job, word_count_with_report_job


# Declared columns of the driver tables that the queries read (no schema
# inference pass before planning).
DOCUMENTS_SCHEMA = "doc_id bigint, text string"
EVENTS_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string"


def _documents(spark: SparkSession, d: str) -> DataFrame:
    return widen(read_table(spark, d, "documents", DOCUMENTS_SCHEMA).select("doc_id", "text"))


def _events(spark: SparkSession, d: str, *cols: str, heavy: bool = True) -> DataFrame:
    # Spread the (single-row-group) table only before heavy per-row work;
    # for light work the extra exchange costs more than it saves.
    events = read_table(spark, d, "events", EVENTS_SCHEMA).select(*cols)
    return widen(events) if heavy else events


def scan_lines(spark: SparkSession, d: str) -> DataFrame:
    return lines_of(_documents(spark, d), "text", keep=["doc_id"])


def tokenize_words(spark: SparkSession, d: str) -> DataFrame:
    return tokenize(scan_lines(spark, d), "line", keep=["doc_id"])


def word_count_q(spark: SparkSession, d: str) -> DataFrame:
    return word_count(tokenize(scan_lines(spark, d), "line"))


def word_count_lines(spark: SparkSession, d: str) -> DataFrame:
    return word_count_text(word_count_q(spark, d))


def _tagged(spark: SparkSession, d: str) -> DataFrame:
    events = _events(spark, d, "event_id", "ts", "user_id", "event_type")
    return tag_access_log(fixtures.access_log_lines(events))


def log_tagged(spark: SparkSession, d: str) -> DataFrame:
    return _tagged(spark, d).select("event_id", "parsed", "reject_reason")


def log_parsed(spark: SparkSession, d: str) -> DataFrame:
    rec = parsed_records(_tagged(spark, d), keep=["event_id"])
    return rec.select(
        "event_id",
        "remote_host",
        "remote_identity",
        "local_identity",
        F.unix_seconds("request_time").alias("request_epoch_s"),
        "method",
        "endpoint",
        "protocol",
        "response_code",
        "content_size",
    )


def log_rejects(spark: SparkSession, d: str) -> DataFrame:
    return rejected_lines(_tagged(spark, d), keep=["event_id"])


def log_counts(spark: SparkSession, d: str) -> DataFrame:
    return access_log_counts(_tagged(spark, d))


def log_content_size(spark: SparkSession, d: str) -> DataFrame:
    return parsed_records(_tagged(spark, d), keep=["event_id"]).select("event_id", "content_size")


def log_json(spark: SparkSession, d: str) -> DataFrame:
    events = _events(spark, d, "event_id", "event_type", heavy=False)
    return events.select(
        "event_id",
        record_json("event_id", "event_type", F.lit(None).cast("string").alias("note")).alias("json"),
    )


def partition_report_q(spark: SparkSession, d: str) -> DataFrame:
    report = partition_report(_events(spark, d, "event_id", heavy=False))
    return report.agg(F.sum("row_count").alias("row_count"))


def partition_report_json(spark: SparkSession, d: str) -> DataFrame:
    """What is the same in every run of the JSON reports: rows reported in all,
    and the keys of each message (null ones are kept)."""
    report = report_json(partition_report(_events(spark, d, "event_id", heavy=False)))
    keys = F.array_join(F.array_sort(F.json_object_keys("json")), ",")
    rows = F.get_json_object("json", "$.row_count").cast("bigint")
    return report.agg(
        F.sum(rows).alias("row_count"), F.min(keys).alias("first_keys"), F.max(keys).alias("last_keys")
    )


def log_times(spark: SparkSession, d: str) -> DataFrame:
    """The instant and the wall clock of each record's request time."""
    rec = parsed_records(_tagged(spark, d), keep=["event_id"])
    return rec.select(
        "event_id",
        F.unix_seconds("request_time").alias("request_epoch_s"),
        F.date_format("request_time_local", "yyyy-MM-dd HH:mm:ss").alias("request_time_local"),
    )


def app_events(spark: SparkSession, d: str) -> DataFrame:
    events = _events(spark, d, "event_id", heavy=False)
    return application_events(fixtures.event_log_lines(events))


#: Forms of the text files that the file queries write and read, with the
#: options of the writes.
FILE_FORMS: dict[str, dict[str, str]] = {"plain": {}, "gzip": {"compression": "gzip"}}


def _through_files(spark: SparkSession, d: str, run) -> list[DataFrame]:
    """For each form: the documents' lines as text files in the shared folder,
    and what ``run(form, input, folder, options)`` makes of them. The lines' files
    are removed; the results stay, since the returned frames read them."""
    found = []
    for form, options in FILE_FORMS.items():
        folder = new_folder(spark, f"files-{form}")
        write_text(scan_lines(spark, d), f"{folder}/lines", col="line", options=options)
        found.append(run(form, f"{folder}/lines", folder, options))
        remove_folder(spark, f"{folder}/lines")
    return found


def files_word_count(spark: SparkSession, d: str) -> DataFrame:
    """The word-count program on text files, plain and gzip: lines written,
    read, counted, and the ``(word,count)`` files read back."""

    def run(form, lines, folder, options):
        word_count_job(spark, lines, f"{folder}/counts", output_options=options)
        return read_lines(spark, f"{folder}/counts").select(F.lit(form).alias("form"), "value")

    first, second = _through_files(spark, d, run)
    return first.unionByName(second)


def files_report(spark: SparkSession, d: str) -> DataFrame:
    """The word count with partition report on text files: what is the same in
    every run of the reports' files, and the words counted beside them."""

    def run(form, lines, folder, options):
        word_count_with_report_job(spark, lines, f"{folder}/counts", f"{folder}/report", output_options=options)
        messages = read_lines(spark, f"{folder}/report").select("value", F.lit(True).alias("told"))
        pairs = read_lines(spark, f"{folder}/counts").select("value", F.lit(False).alias("told"))
        told = F.col("told")
        keys = F.when(told, F.array_join(F.array_sort(F.json_object_keys("value")), ","))
        cnt = F.regexp_extract("value", ",([0-9]+)[)]$", 1)
        return messages.union(pairs).agg(
            F.lit(form).alias("form"),
            F.sum(F.when(told, F.get_json_object("value", "$.row_count").cast("bigint"))).alias("row_count"),
            F.min(keys).alias("first_keys"),
            F.max(keys).alias("last_keys"),
            F.count_if(told & F.get_json_object("value", "$.host").isNull()).alias("without_host"),
            F.sum(F.when(~told, cnt.cast("bigint"))).alias("words"),
        )

    first, second = _through_files(spark, d, run)
    return first.unionByName(second)


def _analysed(spark: SparkSession, d: str, where: str = "true") -> tuple[str, dict[str, int]]:
    """The log-analysis program on the log lines as gzip files in the shared
    folder: the folder with its ``records`` and ``rejects``, and its counts."""
    folder = new_folder(spark, "files-log")
    events = _events(spark, d, "event_id", "ts", "user_id", "event_type")
    lines = fixtures.access_log_lines(events).where(where)
    write_text(lines, f"{folder}/lines", col="value", options=FILE_FORMS["gzip"])
    try:
        return folder, log_analysis_job(spark, f"{folder}/lines", f"{folder}/records", rejects_path=f"{folder}/rejects")
    finally:
        remove_folder(spark, f"{folder}/lines")


def files_log_records(spark: SparkSession, d: str) -> DataFrame:
    """The records that the log-analysis program saved, read back."""
    folder, _ = _analysed(spark, d)
    rec = spark.read.parquet(f"{folder}/records")
    return rec.select(
        "remote_host", F.unix_seconds("request_time").alias("request_epoch_s"), "method", "endpoint", "protocol",
        "response_code", "content_size",
    )


def files_log_rejects(spark: SparkSession, d: str) -> DataFrame:
    """The rejected lines that the log-analysis program saved, read back."""
    folder, _ = _analysed(spark, d)
    return spark.read.parquet(f"{folder}/rejects")


def files_log_guard(spark: SparkSession, d: str) -> DataFrame:
    """What the log-analysis program tells of all log lines, and of none: its
    counts, or the message it stops with."""
    found = []
    for case, where in (("all", "true"), ("none", "false")):
        try:
            counts, message = _analysed(spark, d, where)[1], None
        except EmptyInputError as e:
            counts, message = {}, str(e)
        found.append((case, counts.get("total"), counts.get("failed"), counts.get("ok"), message))
    return spark.createDataFrame(found, "case string, total bigint, failed bigint, ok bigint, message string")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "scan_lines": scan_lines,
    "tokenize_words": tokenize_words,
    "word_count": word_count_q,
    "word_count_lines": word_count_lines,
    "log_tagged": log_tagged,
    "log_parsed": log_parsed,
    "log_rejects": log_rejects,
    "log_times": log_times,
    "log_counts": log_counts,
    "log_content_size": log_content_size,
    "log_json": log_json,
    "partition_report": partition_report_q,
    "partition_report_json": partition_report_json,
    "app_events": app_events,
    "files_word_count": files_word_count,
    "files_report": files_report,
    "files_log_records": files_log_records,
    "files_log_rejects": files_log_rejects,
    "files_log_guard": files_log_guard,
}


# ----------------------------------------------------------------------------
# DuckDB oracles. The access-log and event-log lines are rendered from
# `events` exactly as `fixtures.py` renders them; the parse, split and counts
# are then written independently in DuckDB's own SQL.
# ----------------------------------------------------------------------------

_P = r'^(\S+) (\S+) (\S+) \[([\w:/]+\s[+\-]\d{4})\] "(\S+) (\S+)\s*(\S*)" (\d{3}) (\S+)'

_SQL_SCAN_LINES = r"""
select doc_id, unnest(case when text = '' then []::varchar[]
  else string_split_regex(regexp_replace(text, '(\r\n|\r|\n)$', ''), '\r\n|\r|\n') end) as line
from (select doc_id, case when starts_with(text, chr(65279)) then substr(text, 2) else text end as text
      from documents)
"""

_SQL_TOKENIZE = (
    "with scan_lines as (" + _SQL_SCAN_LINES + ")\n"
    r"""select doc_id, unnest(case when line = '' then [''] when rtrim(line, ' ') = '' then []::varchar[]
  else string_split(rtrim(line, ' '), ' ') end) as word from scan_lines"""
)

_SQL_LOG_LINES = r"""
select event_id, case when event_id % 11 = 0 then 'malformed line ' || event_id
  else 'u' || user_id || '.example.net - - [' || 
    case when event_id % 19 = 0 then '32' else strftime(ts, '%d') end || strftime(ts, '/%b/%Y:')
    || case when event_id % 23 = 0 then '25' else strftime(ts, '%H') end || strftime(ts, ':%M:%S')
    || case event_id % 4 when 0 then ' -0400' when 1 then ' +0000' when 2 then ' +0530' else ' -1130' end || '] "'
    || case event_type when 'purchase' then 'POST' else 'GET' end || ' /' || event_type || '/' || event_id
    || case when event_id % 7 = 0 then '' else ' HTTP/1.0' end || '" '
    || case when event_type = 'error' then '500' when event_id % 10 = 3 then '404' else '200' end || ' '
    || case when event_id % 5 = 0 then '-' when event_id % 17 = 0 then '12x'
            else cast((event_id * 37) % 5000 as varchar) end
    || case when event_id % 13 = 0 then ' trailing' else '' end end as value
from events
"""

_SQL_TAGGED = (
    "with log_lines as (" + _SQL_LOG_LINES + "),\n"
    "t as (select *, case when reject_reason is null then 1 else 0 end as parsed from (\n"
    r""" select *, case when not m then 'no_match' when request_epoch_s is null then 'bad_time'
                when content_size is null then 'bad_size' end as reject_reason from (
  select event_id, value, m,
   case when m then g[1] end as remote_host, case when m then g[2] end as remote_identity,
   case when m then g[3] end as local_identity,
   case when m then cast(epoch_ms(try_strptime(g[4], '%d/%b/%Y:%H:%M:%S %z')) // 1000 as bigint) end as request_epoch_s,
   case when m then try_strptime(left(g[4], length(g[4]) - 6), '%d/%b/%Y:%H:%M:%S') end as wall,
   case when m then g[5] end as method, case when m then g[6] end as endpoint, case when m then g[7] end as protocol,
   case when m then try_cast(g[8] as integer) end as response_code,
   case when not m then null when g[9] = '-' then 0
        when regexp_full_match(g[9], '[+-]?[0-9]+') then try_cast(g[9] as bigint) end as content_size
  from (select event_id, value, regexp_full_match(value, P) as m,
         [regexp_extract(value, P, 1), regexp_extract(value, P, 2), regexp_extract(value, P, 3),
          regexp_extract(value, P, 4), regexp_extract(value, P, 5), regexp_extract(value, P, 6),
          regexp_extract(value, P, 7), regexp_extract(value, P, 8), regexp_extract(value, P, 9)] as g
        from log_lines, (select '"""
    + _P
    + "' as P)))))\n"
)

_SQL_EVENT_LOG_LINES = r"""
select '/logs/app-' || (event_id // 4) as path,
 case event_id % 4
  when 0 then '{"Event":"SparkListenerApplicationStart","App Name":"demo","App ID":"app-' || (event_id // 4)
              || '","Timestamp":' || (1700000000000 + event_id * 1000) || ',"User":"u"}'
  when 1 then '{"Event":"SparkListenerJobStart","Job ID":' || event_id || '}'
  when 2 then '{"Event":"SparkListenerApplicationEnd","Timestamp":' || (1700000000000 + event_id * 1000) || '}'
  else '{"Event":"SparkListenerAppl' end as value
from events
"""

ORACLE_SQL: dict[str, str] = {
    "scan_lines": _SQL_SCAN_LINES,
    "tokenize_words": _SQL_TOKENIZE,
    "word_count": "with w as (" + _SQL_TOKENIZE + ") select word, count(*) as cnt from w group by word",
    "word_count_lines": "with w as (" + _SQL_TOKENIZE + ") "
    "select '(' || word || ',' || count(*) || ')' as value from w group by word",
    "log_tagged": _SQL_TAGGED + "select event_id, parsed, reject_reason from t",
    "log_parsed": _SQL_TAGGED
    + "select event_id, remote_host, remote_identity, local_identity, request_epoch_s, method, endpoint, "
    "protocol, response_code, content_size from t where parsed = 1",
    "log_rejects": _SQL_TAGGED + "select event_id, value, reject_reason as reason from t where parsed = 0",
    "log_times": _SQL_TAGGED + "select event_id, request_epoch_s, "
    "strftime(wall, '%Y-%m-%d %H:%M:%S') as request_time_local from t where parsed = 1",
    "log_counts": _SQL_TAGGED
    + "select count(*) as total, count_if(parsed = 0)::bigint as failed, count_if(parsed = 1)::bigint as ok from t",
    "log_content_size": _SQL_TAGGED + "select event_id, content_size from t where parsed = 1",
    "log_json": """select event_id, '{"event_id":' || event_id || ',"event_type":"' || event_type
        || '","note":null}' as json from events""",
    "partition_report": "select count(*)::bigint as row_count from events",
    "partition_report_json": "select count(*)::bigint as row_count, keys as first_keys, keys as last_keys from events, "
    "(select 'attempt_number,created_at,executor_dirs,host,log_url_stderr,log_url_stdout,partition_id,row_count,user_dir' as keys) "
    "group by keys",
    "files_word_count": "with w as (" + _SQL_TOKENIZE + "), c as (select '(' || word || ',' || count(*) || ')' as value from w group by word) "
    "select form, value from c, (values ('plain'), ('gzip')) as f(form)",
    "files_report": "with l as (" + _SQL_SCAN_LINES + "), w as (" + _SQL_TOKENIZE + ") "
    "select form, (select count(*) from l)::bigint as row_count, keys as first_keys, keys as last_keys, 0::bigint as without_host, "
    "(select count(*) from w)::bigint as words from (values ('plain'), ('gzip')) as f(form), "
    "(select 'attempt_number,created_at,executor_dirs,host,log_url_stderr,log_url_stdout,partition_id,row_count,user_dir' as keys) as k",
    "files_log_records": _SQL_TAGGED
    + "select remote_host, request_epoch_s, method, endpoint, protocol, response_code, content_size from t where parsed = 1",
    "files_log_rejects": _SQL_TAGGED + "select value, reject_reason as reason from t where parsed = 0",
    "files_log_guard": _SQL_TAGGED
    + "select 'all' as case, count(*) as total, count_if(parsed = 0)::bigint as failed, count_if(parsed = 1)::bigint as ok, "
    "null::varchar as message from t union all select 'none', null, null, null, 'No Data found in RDD'",
    "app_events": "with l as (" + _SQL_EVENT_LOG_LINES + "),\n"
    r"""e as (select path, json_extract_string(value, '$.Event') as ev,
    json_extract_string(value, '$."App ID"') as aid, cast(json_extract(value, '$.Timestamp') as bigint) as ts
  from l where json_valid(value))
select coalesce(aid, max(aid) over (partition by path), regexp_extract(path, '[^/]+$')) as app_id,
  case ev when 'SparkListenerApplicationStart' then 'start' else 'end' end as event,
  ts as time_ms,
  'Application ' || case ev when 'SparkListenerApplicationStart' then 'start' else 'end' end
    || ' event captured : time - ' || ts as message
from e where ev in ('SparkListenerApplicationStart', 'SparkListenerApplicationEnd')""",
}
