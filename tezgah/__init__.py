"""Retail star-schema warehouse as Spark DataFrame jobs."""
