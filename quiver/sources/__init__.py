"""Scans and sources (inventory section A)."""
