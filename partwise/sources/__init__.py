"""Readers, writers and the file inventory."""
