"""Scheduled incremental runs as a Structured Streaming trigger.

The job is batch ELT; this package only re-expresses "run the job on every
new drop of order files" (what a scheduler does) with a file-stream source
and ``foreachBatch``.
"""

from .incremental import start_incremental_load

__all__ = ["start_incremental_load"]
