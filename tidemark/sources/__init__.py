"""Readers, writers and published tables."""
