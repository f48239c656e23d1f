"""Column functions: no joins, no shuffles, nothing but expressions."""
