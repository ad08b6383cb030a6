"""Readers and writers for sensor dumps, weather tables and parquet."""
