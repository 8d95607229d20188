"""Reading the input tables, writing results, staging intermediate tables."""
