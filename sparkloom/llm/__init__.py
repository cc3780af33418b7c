"""Operators for preparing large training corpora with Spark."""
