"""DataFrame → DataFrame operators."""

from .access_log import (
    RECORD_COLUMNS,
    access_log_counts,
    parsed_records,
    rejected_lines,
    tag_access_log,
)
from .layout import spread, widen
from .lifecycle import application_events
from .partition_report import REPORT_SCHEMA, partition_report, report_json
from .words import count_words, tokenize, word_count, word_count_text

__all__ = [
    "RECORD_COLUMNS",
    "REPORT_SCHEMA",
    "access_log_counts",
    "application_events",
    "count_words",
    "parsed_records",
    "partition_report",
    "rejected_lines",
    "report_json",
    "spread",
    "tag_access_log",
    "tokenize",
    "widen",
    "word_count",
    "word_count_text",
]
