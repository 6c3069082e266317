"""Relational operators: validation, profiling, deduplication, selection, integrity."""
