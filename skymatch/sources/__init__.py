"""Catalog input, output and schemas."""
