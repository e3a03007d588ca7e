"""Registered queries, their input views over the given tables, and the SQL they must equal."""
