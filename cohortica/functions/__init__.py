"""Column expressions, and small formulas on single numbers."""
