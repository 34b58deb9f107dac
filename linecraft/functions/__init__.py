"""Built-in expressions (no Python in the row path), as SQL text (``*_sql``)
and as Columns."""

from .access_log import (
    access_log_groups,
    access_log_groups_sql,
    access_log_split,
    content_size,
    content_size_sql,
    groups_matched,
    reject_reason,
    reject_reason_sql,
    request_instant,
    request_instant_sql,
    request_wall_clock,
    request_wall_clock_sql,
    status_code,
    status_code_sql,
)
from .records import app_event_message, record_json
from .text import pair_text, pair_text_sql, split_lines, split_lines_sql, split_words, split_words_sql

__all__ = [
    "access_log_groups",
    "access_log_groups_sql",
    "access_log_split",
    "app_event_message",
    "content_size",
    "content_size_sql",
    "groups_matched",
    "pair_text",
    "pair_text_sql",
    "record_json",
    "reject_reason",
    "reject_reason_sql",
    "request_instant",
    "request_instant_sql",
    "request_wall_clock",
    "request_wall_clock_sql",
    "split_lines",
    "split_lines_sql",
    "split_words",
    "split_words_sql",
    "status_code",
    "status_code_sql",
]
