"""Operators on the declared tables."""
