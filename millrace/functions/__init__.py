"""Column expressions: each function takes and returns ``Column`` objects."""
