"""Queries over the supplied tables: one per operator, each with the SQL that checks it."""
