"""Column functions: null rules, geometry, flags."""
