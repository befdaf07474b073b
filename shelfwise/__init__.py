"""Catalogue analytics as Spark DataFrame jobs."""
