"""Queries over the given tables, each with the SQL that an independent engine must agree with."""
