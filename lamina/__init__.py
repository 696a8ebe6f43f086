"""Medallion warehouse for public-health open data, written as Spark DataFrame jobs."""
