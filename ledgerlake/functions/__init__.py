"""Column expressions: business labels, time and measures."""
