"""Column expressions: conversions, ids, text shapes and similarity."""
