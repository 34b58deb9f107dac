"""Column expressions that render records as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .constants import APP_EVENT_MESSAGE

_HEAD, _REST = APP_EVENT_MESSAGE.split("{kind}")
_MIDDLE, _TAIL = _REST.split("{time_ms}")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def record_json(*fields: Column | str) -> Column:
    """One JSON object per row, fields in the given order.

    Null fields stay in the text as ``null`` (the Spark default drops them);
    pass times as epoch millis (``F.unix_millis``) to get the usual JSON form
    of a date.
    """
    return F.to_json(F.struct(*[_col(f) for f in fields]), {"ignoreNullFields": "false"})


def app_event_message(kind: Column | str, time_ms: Column | str) -> Column:
    """``Application <kind> event captured : time - <epoch ms>``."""
    return F.concat(
        F.lit(_HEAD),
        _col(kind),
        F.lit(_MIDDLE),
        _col(time_ms).cast("string"),
        F.lit(_TAIL),
    )
