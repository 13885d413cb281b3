"""Readers, loaders and table writers."""
