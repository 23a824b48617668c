"""DataFrame-level operators: records, store, log, dedup, coverage and cross-check."""
