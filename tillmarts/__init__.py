"""Retail sales, stock and ad-spend marts as Spark DataFrame functions."""
