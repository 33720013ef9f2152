"""Batch analytics for word-aligned parallel texts, written with Spark DataFrames."""
