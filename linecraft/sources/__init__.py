"""Sources: text lines, event logs, parquet tables."""

from .event_log import UnreadableLogError, read_event_log_lines
from .text import lines_of, object_store_options, read_lines, read_table

__all__ = [
    "UnreadableLogError",
    "lines_of",
    "object_store_options",
    "read_event_log_lines",
    "read_lines",
    "read_table",
]
