"""Column-expression helpers; every one returns a Spark ``Column`` (no Python per row)."""
