"""Registered queries over the generic tables, each with the SQL that computes the same rows."""
