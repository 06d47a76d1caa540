"""Jobs: each reads tables by path, applies operators and writes tables."""
