"""Readers, writers and the mapping of the shared test tables."""
