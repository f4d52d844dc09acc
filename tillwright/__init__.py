"""Transaction analytics on Spark: metrics, logs, rollups and streams of purchase records."""
