"""Reading, writing and maintaining tables."""
