"""Operators on detection and object catalogs."""
