"""Expressions that parse one web-server access-log line.

Most expressions are written once as Spark SQL text (``*_sql`` functions
take column names or SQL expressions and return SQL); the Column forms wrap
that text with ``F.expr``. One SQL string is one call into the JVM, where
building the same tree from Column objects takes hundreds. The SQL text
holds no backslash, so it means the same under any string-escape setting;
the regex is passed to Spark as a plain string through the Column API
(:func:`access_log_split`) and never parsed as SQL.

The whole-line pattern is evaluated once per line: ``regexp_replace``
rewrites a matching line into its nine groups joined by U+0001 and ``split``
cuts them apart. A line that already holds U+0001 could fake a match that
way, so such lines take the slower route of one ``regexp_extract`` per group.
Both routes give the same groups as a whole-line match of the pattern.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .constants import (
    ACCESS_LOG_FAST_REGEX,
    ACCESS_LOG_TIME_LAYOUT,
    BAD_SIZE,
    BAD_TIME,
    NO_MATCH,
)

_SEP = "\u0001"
# endpoint is group 6 or, without a protocol, group 8; the other is empty
_GROUPS = ((1,), (2,), (3,), (4,), (5,), (6, 8), (7,), (9,), (10,))
_GROUPS_JOINED = _SEP.join("".join(f"${i}" for i in g) for g in _GROUPS)
_DIGITS = "0123456789"


def access_log_split(line: str) -> Column:
    """array<string>: the nine groups if the whole line matches; otherwise an
    array of another length, or null. Feed it to :func:`access_log_groups_sql`
    in a later projection, so the regex runs once per line."""
    v = F.expr(line)
    one_pass = F.split(F.regexp_replace(v, ACCESS_LOG_FAST_REGEX, _GROUPS_JOINED), _SEP, -1)
    group = lambda i: F.regexp_extract(v, ACCESS_LOG_FAST_REGEX, i)
    per_group = F.array(*[F.concat(*map(group, g)) for g in _GROUPS])
    return F.when(F.instr(v, _SEP) == 0, one_pass).when(v.rlike(ACCESS_LOG_FAST_REGEX), per_group)


def access_log_groups_sql(split: str) -> str:
    """array<string> of the nine groups if the line matched, else null."""
    return f"CASE WHEN size({split}) = 9 THEN {split} END"


def _wall_sql(time_text: str) -> str:
    # The group is `[\w:/]+\s[+-]\d{4}`: wall clock, one blank, offset.
    return f"left({time_text}, length({time_text}) - 6)"


def request_instant_sql(time_text: str) -> str:
    """timestamp: the request time with its UTC offset applied; null if the
    text is not a real date (no roll-over of day 32 or hour 25)."""
    return (
        f"try_to_timestamp(concat({_wall_sql(time_text)}, ' ', right({time_text}, 5)), "
        f"'{ACCESS_LOG_TIME_LAYOUT} Z')"
    )


def request_wall_clock_sql(time_text: str, instant: str) -> str:
    """timestamp_ntz: the wall-clock reading of the request time, offset
    ignored (how the original program read it). Null where ``instant`` is
    null, which also keeps the ANSI parse from raising on bad text."""
    return (
        f"CASE WHEN {instant} IS NOT NULL "
        f"THEN to_timestamp_ntz({_wall_sql(time_text)}, '{ACCESS_LOG_TIME_LAYOUT}') END"
    )


def status_code_sql(text: str) -> str:
    """int from the three-digit status group."""
    return f"try_cast({text} AS int)"


def content_size_sql(text: str) -> str:
    """bigint size: ``-`` is 0, a Java long (optional sign, ASCII digits) is
    its value, anything else null. The digit check is a ``translate``, not a
    regex: no per-row pattern matching and no backslash in the SQL."""
    unsigned = f"CASE WHEN left({text}, 1) IN ('+', '-') THEN substring({text}, 2) ELSE {text} END"
    return (
        f"CASE WHEN {text} = '-' THEN 0L "
        f"WHEN ({unsigned}) <> '' AND translate({unsigned}, '{_DIGITS}', '') = '' "
        f"THEN try_cast({text} AS bigint) END"
    )


def reject_reason_sql(matched: str, instant: str, size: str) -> str:
    """Why a line is not a record: no match, bad time, bad size; else null.

    Checked in the order the original program evaluates the fields (time
    before size)."""
    return (
        f"CASE WHEN NOT {matched} THEN '{NO_MATCH}' WHEN {instant} IS NULL THEN '{BAD_TIME}' "
        f"WHEN {size} IS NULL THEN '{BAD_SIZE}' END"
    )


# Column forms ----------------------------------------------------------------


def access_log_groups(split: str) -> Column:
    return F.expr(access_log_groups_sql(split))


def groups_matched(groups: str) -> Column:
    """True if :func:`access_log_groups` found a whole-line match."""
    return F.expr(f"{groups} IS NOT NULL")


def request_instant(time_text: str) -> Column:
    return F.expr(request_instant_sql(time_text))


def request_wall_clock(time_text: str, instant: str) -> Column:
    return F.expr(request_wall_clock_sql(time_text, instant))


def status_code(text: str) -> Column:
    return F.expr(status_code_sql(text))


def content_size(text: str) -> Column:
    return F.expr(content_size_sql(text))


def reject_reason(matched: str, instant: str, size: str) -> Column:
    return F.expr(reject_reason_sql(matched, instant, size))
