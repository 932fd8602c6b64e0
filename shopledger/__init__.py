"""Retail medallion pipeline written as Spark DataFrame jobs."""
