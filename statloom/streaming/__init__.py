"""Incremental landing of raw files."""
