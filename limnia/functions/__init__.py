"""Column expressions: cleaning, time labels, text, flags, geometry."""
