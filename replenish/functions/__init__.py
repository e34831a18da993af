"""Column expressions and date-window arithmetic shared by the operators."""
