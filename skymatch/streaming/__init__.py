"""Visits as a stream."""
