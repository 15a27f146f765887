"""Column expressions: labels, keys, sequences and the few vectorised statistics helpers."""
