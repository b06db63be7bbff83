"""Relational operators that are independent of the commerce schema."""
