"""Building blocks that Spark has no single operator for: joins with hot keys, exact percentiles at scale."""
