"""Larkspur: data operators for analytics and data engineering, written for PySpark."""
