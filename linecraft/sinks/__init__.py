"""Sinks: text, JSON lines, parquet."""

from .files import write_json_lines, write_pairs_text, write_records, write_text

__all__ = ["write_json_lines", "write_pairs_text", "write_records", "write_text"]
