"""Article screening on Spark: select, extract, clean, deduplicate, score and filter."""
