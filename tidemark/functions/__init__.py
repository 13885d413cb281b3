"""Portable scalar, aggregate and user-defined functions."""
