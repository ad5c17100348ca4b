"""Incremental loading of raw files."""
