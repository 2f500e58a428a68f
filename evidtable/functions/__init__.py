"""Column functions: units, cells, text."""
