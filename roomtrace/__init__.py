"""Smart-home sensor analytics as Spark DataFrame jobs."""
