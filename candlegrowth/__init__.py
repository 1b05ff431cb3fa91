"""Growth reports over price candles, as plain Spark DataFrame jobs."""
