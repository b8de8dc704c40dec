"""Relational operators (DataFrame -> DataFrame)."""
