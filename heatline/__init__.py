"""Toxicity signals over message streams and tables, as Spark jobs."""
