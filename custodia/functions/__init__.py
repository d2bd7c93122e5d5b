"""Column expressions: parsing, rules, ordered statistics."""
