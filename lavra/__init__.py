"""Medallion layers, data quality and target indicators as Spark jobs."""
