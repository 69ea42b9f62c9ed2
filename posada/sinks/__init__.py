"""Table publication, capped extracts and load verification."""
