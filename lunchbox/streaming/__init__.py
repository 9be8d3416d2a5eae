"""Structured Streaming runners for the batch plans."""
