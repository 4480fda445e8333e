"""Profiling: types of text, column statistics, keys, and a proposed schema."""
