"""Column expressions: no shuffle, no action, everything row-local."""
