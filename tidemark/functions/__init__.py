"""Column expressions: sequence numbers, hash keys, text."""
