"""Column expressions and naming rules."""
