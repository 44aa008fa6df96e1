"""Column expressions: tolerant casts, dates, rounding."""
