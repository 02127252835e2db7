"""Queries that apply the operators to the driver tables, with SQL twins."""
