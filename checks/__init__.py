"""Each operator over the given tables, next to the same query as SQL text."""
