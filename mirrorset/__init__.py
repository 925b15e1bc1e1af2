"""Synthetic, anonymised copies of relational tables, built with Spark DataFrames."""

__version__ = "0.1.0"
