"""Composite data products built from the operators."""
