"""Readers, writers and landing jobs."""
