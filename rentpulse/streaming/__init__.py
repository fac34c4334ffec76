"""Incremental loading driven by arriving files."""
