"""DataFrame -> DataFrame operators: facts, views, reports, the analysis pack,
cohorts, the cost upsert, audits, hot-key-safe sequences, keys and top-k."""
