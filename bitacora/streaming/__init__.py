"""Reports from files that keep arriving."""

from bitacora.streaming.report import read_report_stream, stream_files, stream_report

__all__ = ["read_report_stream", "stream_files", "stream_report"]
