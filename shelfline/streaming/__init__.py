"""Arrival-driven incremental runs.

The original pipeline has no streaming operator; its incremental mode is a
daily run for a date.  :func:`process_new_days` lets the raw landing folder
decide which dates to run: a Structured Streaming file source over the raw
sales (availableNow trigger, progress kept in a checkpoint) hands each batch
of newly landed files to the daily transform, model and aggregate jobs.
"""
from .landing import process_new_days

__all__ = ["process_new_days"]
