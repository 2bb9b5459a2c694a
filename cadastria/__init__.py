"""Property-sales analytics as Spark jobs."""
