"""Column expressions: names, keys, typed values."""
