"""Paged, nested JSON records to clean, versioned tables, as plain Spark DataFrame jobs."""
