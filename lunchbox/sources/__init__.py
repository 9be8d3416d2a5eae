"""Readers: the normalised HR model, sheet-like feeds, seeds and rules."""
