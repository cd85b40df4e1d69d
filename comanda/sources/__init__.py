"""Readers of operational tables."""
