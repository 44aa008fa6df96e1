"""Readers, writers and storage layout."""
