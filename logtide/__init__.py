"""Usage-pattern analytics over access logs, as Spark jobs."""
