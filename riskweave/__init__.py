"""Transaction-risk analytics expressed as Spark DataFrame, ML and streaming jobs."""
