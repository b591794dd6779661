"""Jobs (ingest, transform, model, aggregate), their mode dispatch, and the
catalog of named queries used by tests, bench and the correctness gate."""
