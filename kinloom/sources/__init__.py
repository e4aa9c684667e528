"""Readers, writers and declarative source descriptions."""
