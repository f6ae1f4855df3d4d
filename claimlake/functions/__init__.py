"""Column expressions: text, identifiers and hashes."""
