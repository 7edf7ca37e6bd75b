"""Column functions: time zones, text and measures."""
