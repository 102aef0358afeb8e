"""Column expressions: geometry, encodings and text."""
