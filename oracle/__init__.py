"""Independent SQL for every registered query, for an embedded SQL engine over the same tables."""
