"""Interval, coverage and data-quality operators as composable PySpark DataFrame functions."""

__version__ = "0.1.0"
