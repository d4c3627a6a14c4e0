"""The given tables seen as community data, and one query with its SQL counterpart per operator."""
