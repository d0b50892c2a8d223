"""Immune-repertoire analytics as Spark DataFrame queries."""
