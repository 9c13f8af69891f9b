"""The registered queries: every operator over views of the given tables."""
