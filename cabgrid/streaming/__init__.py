"""Structured Streaming variants of the route query and the column stream."""
