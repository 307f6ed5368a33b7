"""Column expressions and the few vectorised UDFs."""
