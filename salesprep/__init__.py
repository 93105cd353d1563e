"""Monthly retail sales preparation as Spark jobs."""
