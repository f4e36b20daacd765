"""Retail analytics as table-in, table-out Spark jobs."""
