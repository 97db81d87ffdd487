"""Column-expression helpers (no Python per row)."""
