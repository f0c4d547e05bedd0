"""Incremental monitoring."""
