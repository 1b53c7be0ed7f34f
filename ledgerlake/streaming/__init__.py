"""Structured Streaming jobs: change feeds, ticks and refresh of touched days."""
