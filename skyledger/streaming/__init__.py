"""Intake of files as they land."""
