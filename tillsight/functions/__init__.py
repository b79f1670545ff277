"""Column expressions and ordered-set helpers."""
