"""Stand-in inputs rendered from the driver's ``events`` table.

The test tables hold no access logs and no event logs, so these functions
write lines of that shape from ``events`` rows. They only produce input rows;
every parse, filter and count is done by the operators, which know nothing of
how the lines were made. The same renderings, in DuckDB SQL, open the oracle
queries in ``linecraft/plans/registered.py``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

# Fixed value: English month abbreviations as used in access-log times.
_MONTHS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")
_MONTH_ARRAY = "array(" + ", ".join(f"'{m}'" for m in _MONTHS) + ")"


def _two(expr: str) -> str:
    return f"lpad(CAST({expr} AS string), 2, '0')"


# dd/MMM/yyyy:HH:mm:ss from field values, so the text does not depend on the
# session time zone (ts is timestamp_ntz).
_CLF_TIME = (
    f"concat(CASE WHEN event_id % 19 = 0 THEN '32' ELSE {_two('dayofmonth(ts)')} END, "
    f"'/', element_at({_MONTH_ARRAY}, month(ts)), '/', CAST(year(ts) AS string), ':', "
    f"CASE WHEN event_id % 23 = 0 THEN '25' ELSE {_two('hour(ts)')} END, "
    f"':', {_two('minute(ts)')}, ':', {_two('second(ts)')}, "
    "CASE event_id % 4 WHEN 0 THEN ' -0400' WHEN 1 THEN ' +0000' WHEN 2 THEN ' +0530' ELSE ' -1130' END)"
)

_ACCESS_LOG_LINE = f"""
CASE WHEN event_id % 11 = 0 THEN concat('malformed line ', CAST(event_id AS string))
ELSE concat(
  'u', CAST(user_id AS string), '.example.net - - [', {_CLF_TIME}, '] "',
  CASE WHEN event_type = 'purchase' THEN 'POST' ELSE 'GET' END,
  ' /', event_type, '/', CAST(event_id AS string),
  CASE WHEN event_id % 7 = 0 THEN '' ELSE ' HTTP/1.0' END, '" ',
  CASE WHEN event_type = 'error' THEN '500' WHEN event_id % 10 = 3 THEN '404' ELSE '200' END, ' ',
  CASE WHEN event_id % 5 = 0 THEN '-' WHEN event_id % 17 = 0 THEN '12x'
       ELSE CAST((event_id * 37) % 5000 AS string) END,
  CASE WHEN event_id % 13 = 0 THEN ' trailing' ELSE '' END)
END"""

_APP = "concat('app-', CAST(event_id div 4 AS string))"
_TS = "CAST(1700000000000 + event_id * 1000 AS string)"
_EVENT_LOG_LINE = f"""
CASE event_id % 4
  WHEN 0 THEN concat('{{"Event":"SparkListenerApplicationStart","App Name":"demo","App ID":"', {_APP},
                     '","Timestamp":', {_TS}, ',"User":"u"}}')
  WHEN 1 THEN concat('{{"Event":"SparkListenerJobStart","Job ID":', CAST(event_id AS string), '}}')
  WHEN 2 THEN concat('{{"Event":"SparkListenerApplicationEnd","Timestamp":', {_TS}, '}}')
  ELSE '{{"Event":"SparkListenerAppl'
END"""


def access_log_lines(events: DataFrame) -> DataFrame:
    """``event_id bigint, value string``: one access-log line per event; some
    are malformed, have trailing text, no protocol, a ``-`` size, a size that
    is not a number, a day 32 or an hour 25; offsets differ."""
    return events.selectExpr("event_id", f"{_ACCESS_LOG_LINE} AS value")


def event_log_lines(events: DataFrame) -> DataFrame:
    """``path string, value string``: JSON event-log lines, four per
    application log: start, a job event, end, and a line cut short."""
    return events.selectExpr(f"concat('/logs/', {_APP}) AS path", f"{_EVENT_LOG_LINE} AS value")
