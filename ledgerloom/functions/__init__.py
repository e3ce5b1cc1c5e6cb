"""Column-level building blocks: dates, keys and amounts, text."""
