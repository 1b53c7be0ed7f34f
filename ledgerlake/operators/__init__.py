"""Table operators: projections, latest version, writes, keyed upsert and load reports."""
