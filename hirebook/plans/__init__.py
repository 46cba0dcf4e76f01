"""Plans: the registered report queries (Spark side) and their SQL oracle."""
