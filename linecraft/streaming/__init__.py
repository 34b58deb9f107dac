"""Structured Streaming versions of the line operators."""

from .file_stream import start_parsed_log_stream, start_running_counts_stream, stream_lines

__all__ = ["start_parsed_log_stream", "start_running_counts_stream", "stream_lines"]
