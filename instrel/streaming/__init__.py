"""Incremental runs as file streams."""
