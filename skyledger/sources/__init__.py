"""Readers, writers and named sources."""
