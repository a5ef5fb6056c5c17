"""Column expressions: text, numbers, names and rules."""
