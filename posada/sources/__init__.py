"""Landing of raw files and scans of landed collections."""
