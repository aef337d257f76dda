"""Registered queries, their fixtures and reference SQL."""
