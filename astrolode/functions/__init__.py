"""Column expressions: blank predicates, safe casts, calendar parts, provenance."""
