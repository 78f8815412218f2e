"""Named queries over the given tables, and the same in plain SQL."""
