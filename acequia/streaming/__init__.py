"""Incremental loads over arriving files."""
