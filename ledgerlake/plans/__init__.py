"""Composed pipelines: silver tables and gold products."""
