"""Streaming entry point: an availableNow file-stream trigger over the
incoming folder that hands newly arrived files to the per-file loads."""

from .incoming import incoming_files_stream, run_incoming_stream

__all__ = ["incoming_files_stream", "run_incoming_stream"]
