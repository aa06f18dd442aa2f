"""Column expressions: no DataFrame, no shuffle."""
