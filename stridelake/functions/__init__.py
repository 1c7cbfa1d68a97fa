"""Column -> Column builders for the cleaning rules (no DataFrame knowledge)."""
