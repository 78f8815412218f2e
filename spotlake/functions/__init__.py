"""Column-level rules: text, dates, numbers, parameters."""
