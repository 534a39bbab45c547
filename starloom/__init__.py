"""Dimensional-warehouse operators, builders and flows on the Spark DataFrame API."""
