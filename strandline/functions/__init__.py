"""Column expressions and key generators."""
