"""Column-expression helpers: time arithmetic, rounding, regex fields, score bands."""
