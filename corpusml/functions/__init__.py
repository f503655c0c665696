"""Column expressions: text, hashing and vectors."""
