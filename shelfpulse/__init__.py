"""Retail price and stock monitoring as plain Spark DataFrame jobs."""
