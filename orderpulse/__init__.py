"""Order-fluctuation analytics on Spark: ingest, dimensions, daily comparison."""
