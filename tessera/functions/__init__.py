"""Column expressions: casts, calendar, text, nested values, geometry, vectors."""
