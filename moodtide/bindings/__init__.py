"""The given tables bound to the library: derived inputs, queries, checks."""
