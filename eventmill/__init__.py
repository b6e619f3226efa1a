"""Commerce click events on Spark: ingest, validate, de-duplicate, aggregate, serve."""
