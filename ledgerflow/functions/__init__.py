"""Column-expression and distributed row/prefix helpers."""
