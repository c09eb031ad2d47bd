"""Registered queries: the jobs over the given tables, and the SQL they must equal."""
