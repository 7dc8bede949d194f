"""Incremental forms of the ingest jobs on Structured Streaming file sources.

The source system has no streams; its two folder jobs (file register, newest
payment drop) are naturally incremental, and a checkpointed file stream gives
them exactly-once behaviour across runs (a re-run never registers a file
twice).  Run them with ``availableNow`` on a schedule, like the batch jobs.
"""

from retally.streaming.drops import payment_drop_stream, register_stream

__all__ = ["payment_drop_stream", "register_stream"]
