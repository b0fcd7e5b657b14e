"""Operators bound to concrete tables."""
