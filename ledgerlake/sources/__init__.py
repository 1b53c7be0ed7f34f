"""Reading: relational extracts, warehouse scans, change and tick streams, and the test-table bindings."""
