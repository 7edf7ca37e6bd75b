"""Operators on tables: conforming, upsert, quality checks, windows."""
