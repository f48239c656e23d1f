"""Reusable DataFrame operators: deduplication, change history, as-of join, exact quantiles, completeness."""
