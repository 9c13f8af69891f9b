"""Dependency analytics on Spark: who touches which data, and how data flows."""
