"""Column expressions: text, numbers, geometry, index formula, display."""
