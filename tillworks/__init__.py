"""Sales analytics on Spark: star schema, query catalogue, loads, checks and learning jobs."""
