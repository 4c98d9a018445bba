"""Berth-schedule lakehouse on PySpark."""
