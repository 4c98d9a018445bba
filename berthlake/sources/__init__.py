"""Readers: raw snapshot files, lakehouse tables, JDBC tables."""
