"""Column expressions: text parsing and date rules."""
