"""Medallion sports-analytics engine on PySpark."""
