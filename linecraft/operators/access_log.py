"""Web-server access-log analysis: tag, split into records and rejects, count."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.access_log import (
    access_log_groups_sql,
    access_log_split,
    content_size_sql,
    reject_reason_sql,
    request_instant_sql,
    request_wall_clock_sql,
    status_code_sql,
)
from ..functions.constants import BAD_SIZE, BAD_TIME, EMPTY_INPUT_MESSAGE
from ..functions.names import quote

_GROUP_NAMES = (
    "remote_host",
    "remote_identity",
    "local_identity",
    "__time",
    "method",
    "endpoint",
    "protocol",
    "__code",
)

RECORD_COLUMNS = (
    "remote_host",
    "remote_identity",
    "local_identity",
    "request_time",
    "request_time_local",
    "method",
    "endpoint",
    "protocol",
    "response_code",
    "content_size",
)


def tag_access_log(lines: DataFrame, value_col: str = "value", on_error: str = "reject") -> DataFrame:
    """Parse every line and tag it.

    Adds the nine typed fields (``remote_host, remote_identity,
    local_identity, request_time timestamp, request_time_local timestamp_ntz,
    method, endpoint, protocol, response_code int, content_size bigint``),
    ``parsed int`` (1 = record, 0 = not) and ``reject_reason string``
    (``no_match``, ``bad_time``, ``bad_size`` or null). All input columns are
    kept, the raw line included.

    ``on_error="fail"`` aborts the job on a line that matches the pattern but
    has an impossible time or a size that is not a long, as the original
    program did; ``"reject"`` (default) tags such lines instead.
    """
    if on_error not in ("reject", "fail"):
        raise ValueError(f"on_error must be 'reject' or 'fail', not {on_error!r}")
    v = quote(value_col)
    inputs = [quote(c) for c in lines.columns]
    # Each step is its own projection so that the regex result is computed
    # once and then only referenced (Catalyst does not inline a costly
    # expression into several consumers).
    step = lines.select("*", access_log_split(v).alias("__s"))
    g = access_log_groups_sql("__s")  # refers to the column, not the regex
    step = step.selectExpr(
        *inputs,
        f"({g}) IS NOT NULL AS __m",
        *[f"({g})[{i}] AS {name}" for i, name in enumerate(_GROUP_NAMES)],
        f"{content_size_sql(f'({g})[8]')} AS content_size",
    )
    step = step.selectExpr("*", f"{request_instant_sql('__time')} AS request_time")
    step = step.selectExpr("*", f"{reject_reason_sql('__m', 'request_time', 'content_size')} AS reject_reason")
    decided = ", ".join(
        inputs
        + [
            "remote_host", "remote_identity", "local_identity", "__time", "request_time",
            "method", "endpoint", "protocol", "__code", "content_size",
            "CASE WHEN reject_reason IS NULL THEN 1 ELSE 0 END AS parsed",
            "reject_reason",
        ]
    )
    # Barrier: the row leaves through a one-element `inline`. A later
    # `where(parsed = 1)` cannot be pushed below a generator, so the
    # optimizer does not copy the regex and time parse into the filter (it
    # otherwise inlines them once per use, which runs the regex many times
    # per line and outgrows the 64 KB codegen limit).
    tagged = step.selectExpr(f"inline(array(struct({decided})))")
    if on_error == "fail":
        tagged = tagged.where(
            f"CASE WHEN reject_reason IN ('{BAD_TIME}', '{BAD_SIZE}') "
            f"THEN raise_error(concat('unparsable access-log line: ', {v})) ELSE true END"
        )
    # Fields not needed to decide `parsed` are derived after the barrier:
    # column pruning drops them when unused, and filters run before them.
    return tagged.selectExpr(
        *inputs,
        "remote_host",
        "remote_identity",
        "local_identity",
        "request_time",
        f"{request_wall_clock_sql('__time', 'request_time')} AS request_time_local",
        "method",
        "endpoint",
        "protocol",
        f"{status_code_sql('__code')} AS response_code",
        "content_size",
        "parsed",
        "reject_reason",
    )


def parsed_records(tagged: DataFrame, keep: Iterable[str] = ()) -> DataFrame:
    """Only parsed lines, as records: the ``keep`` columns and the ten record
    columns."""
    return tagged.where("parsed = 1").select(*keep, *RECORD_COLUMNS)


def rejected_lines(tagged: DataFrame, keep: Iterable[str] = (), value_col: str = "value") -> DataFrame:
    """Only lines that are not records: the ``keep`` columns, the raw line and
    ``reason``."""
    return tagged.where("parsed = 0").select(*keep, value_col, F.col("reject_reason").alias("reason"))


def access_log_counts(tagged: DataFrame, fail_on_empty: bool = True) -> DataFrame:
    """``total, failed, ok`` (bigint) in one pass over the tagged lines.

    With ``fail_on_empty`` the job raises ``No Data found in RDD`` when there
    is no line at all. The check is part of the same aggregate, so it costs no
    extra job. Each task sends one partial row to the final aggregate.
    """
    counts = tagged.selectExpr(
        "count(1) AS total",
        "count_if(parsed = 0) AS failed",
        "count_if(parsed = 1) AS ok",
    )
    if not fail_on_empty:
        return counts
    return counts.selectExpr(
        f"CASE WHEN total = 0 THEN raise_error('{EMPTY_INPUT_MESSAGE}') ELSE total END AS total",
        "failed",
        "ok",
    )
