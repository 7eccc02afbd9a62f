"""Queries over the given test tables, each with the SQL that checks it."""
