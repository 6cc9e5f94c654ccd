"""Contracts between mappings and tables, and additive schema plans."""
