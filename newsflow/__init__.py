"""News and document feeds on Spark: clean, tag, de-duplicate, store, report."""
