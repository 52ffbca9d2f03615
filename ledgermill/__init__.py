"""Retail-banking warehouse, marts and quality checks as Spark jobs."""
