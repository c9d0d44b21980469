"""Column expressions, all built in to Spark."""
