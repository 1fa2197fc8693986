"""Queries over the given tables and the SQL that says what each must return."""
