"""Queries over the given tables, each with an equivalent SQL text where there is one."""
