"""Registered queries over the given tables, each beside its ANSI SQL twin."""
