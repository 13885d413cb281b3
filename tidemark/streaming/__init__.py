"""Structured Streaming adapters that reuse the batch operators."""
