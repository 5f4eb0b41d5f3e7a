"""Query-level compositions (Q1-Q4)."""
