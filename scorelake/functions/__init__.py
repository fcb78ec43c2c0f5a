"""Column expressions: every per-row rule, with no Python in the row path."""
