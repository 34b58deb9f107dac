"""Application start and end messages from Spark event logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.constants import APP_END_EVENT, APP_START_EVENT
from ..functions.records import app_event_message

_EVENT_FIELDS = "Event string, `App ID` string, Timestamp bigint"
# An event name can only be spelt differently in JSON with a \u escape, so a
# line without the literal name and without "\u" cannot be one of the two
# events; only the rest is parsed.
_NAME_STEM = "SparkListenerApplication"
_UNICODE_ESCAPE = "\\u"


def _log_key(path):
    """The log a line belongs to, by its full path.

    Rolling logs: ``.../eventlog_v2_<app>[_<attempt>]/events_<n>_<app>...``, the
    folder. Single-file logs: ``.../<app>[_<attempt>][.<codec>][.inprogress]``,
    the file without its suffixes."""
    parent = F.regexp_extract(path, r"([^/]+)/[^/]+\z", 1)
    folder = F.regexp_replace(path, r"/[^/]+\z", "")
    file = F.regexp_replace(path, r"(\.(zstd|zst|gz))?(\.inprogress)?\z", "")
    return F.when(parent.startswith("eventlog_v2_"), folder).otherwise(file)


def _id_in_name(log):
    """The application id in a log's name, without the attempt's number. Ids of
    the form ``application_<n>_<n>`` hold two numbers themselves."""
    name = F.regexp_replace(F.regexp_extract(log, r"([^/]+)\z", 1), r"\Aeventlog_v2_", "")
    return F.regexp_replace(name, r"\A(application_\d+_\d+|(?!application_).+)_\d+\z", "$1")


def application_events(log_lines: DataFrame, path_col: str = "path", value_col: str = "value") -> DataFrame:
    """``app_id, event, time_ms, message``: one row per application start
    (``event = 'start'``) or end (``'end'``) event.

    ``message`` is ``Application start event captured : time - <ms>`` (or
    ``end``). An end event carries no application id, so it takes the id of
    the start event in the same log, or else the id in the log's file name.
    Lines that are not JSON, or are cut short, are skipped.

    The log lines are read once. Only the start/end rows (a few per log:
    one start and one end per application attempt) are exchanged, keyed by
    log, to share the id within each log; the raw lines never are.
    """
    v = F.col(value_col)
    candidates = log_lines.where((F.instr(v, _NAME_STEM) > 0) | (F.instr(v, _UNICODE_ESCAPE) > 0))
    events = candidates.select(
        _log_key(F.col(path_col)).alias("__log"),
        F.from_json(v, _EVENT_FIELDS).alias("__e"),
    ).where(F.col("__e.Event").isin(APP_START_EVENT, APP_END_EVENT))
    own_id = F.col("__e.`App ID`")
    log_id = F.max(own_id).over(Window.partitionBy("__log"))
    kind = F.when(F.col("__e.Event") == APP_START_EVENT, F.lit("start")).otherwise(F.lit("end"))
    time_ms = F.col("__e.Timestamp")
    return events.select(
        F.coalesce(own_id, log_id, _id_in_name(F.col("__log"))).alias("app_id"),
        kind.alias("event"),
        time_ms.alias("time_ms"),
        app_event_message(kind, time_ms).alias("message"),
    )
