"""Registered queries: catalogue views over the given tables, queries, SQL to check them."""
