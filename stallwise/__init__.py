"""Product, review and price analytics as Spark jobs."""
