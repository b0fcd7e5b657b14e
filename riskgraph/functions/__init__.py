"""Scalar building blocks: every function maps columns to a column."""
