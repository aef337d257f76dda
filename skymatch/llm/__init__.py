"""Operators for preparing training text: scans, deduplication, scoring, mixing, sharding and token files.

Nothing else in the library imports this subpackage.
"""
