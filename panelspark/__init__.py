"""panelspark: temporal-panel analytics on stock Spark."""
