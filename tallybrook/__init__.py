"""Log, text and behaviour analytics as plain Spark DataFrame jobs."""
