"""Encyclopedia-dump analytics as Spark DataFrame jobs."""
