"""Household inventory analytics as Spark jobs."""
