"""The registered queries: every operator over dump lines made from the given tables."""
