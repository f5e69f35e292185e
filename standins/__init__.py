"""Queries over the given tables that exercise the intake's operators."""
