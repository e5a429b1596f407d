"""Readers, writers and the mapping declaration."""
