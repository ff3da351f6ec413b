"""Relational operators composed from DataFrame calls."""
