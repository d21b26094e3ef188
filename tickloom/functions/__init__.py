"""Column-level building blocks."""
