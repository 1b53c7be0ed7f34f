"""Brokerage lakehouse as plain Spark DataFrame and Structured Streaming functions."""
