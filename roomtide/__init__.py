"""Room-climate sensor analytics as Spark DataFrame transforms."""
