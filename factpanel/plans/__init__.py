"""Whole jobs over a landed root."""
