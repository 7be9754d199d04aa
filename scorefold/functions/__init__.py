"""Column expressions: scales, casts, bands, rules, text."""
