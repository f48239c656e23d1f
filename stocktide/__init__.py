"""Distribution analytics on Spark: feed cleaning, versioned dimensions, reconciliation, completeness and KPIs."""
