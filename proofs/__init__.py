"""Proof queries: each operator on the provided tables, next to the same result as plain SQL."""
