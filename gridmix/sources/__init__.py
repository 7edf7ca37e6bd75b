"""Scans of exports, payloads, seeds and stored tables."""
