"""shelfline: retail lakehouse jobs (ingest, clean, model, aggregate) written as
plain Spark DataFrame functions.

Layers: raw -> cleaned -> curated -> serving.  Every business operator takes and
returns DataFrames; jobs in :mod:`shelfline.plans` read, call operators and
publish through :mod:`shelfline.sinks`.
"""

__version__ = "0.1.0"
