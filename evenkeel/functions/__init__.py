"""Column-level building blocks: hashing, column lists, value mapping."""
