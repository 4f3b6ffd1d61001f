"""Column expressions: text and digests, source types, comparison rules."""
