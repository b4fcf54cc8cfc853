"""Batch operators on trips, access logs and social graphs, written as Spark DataFrame jobs."""
