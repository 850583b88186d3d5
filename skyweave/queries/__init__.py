"""Queries over the given tables, one or more per operator, with SQL that must agree."""
