"""Staging, marts, analytics, star schema and whole jobs, built from the operators."""
