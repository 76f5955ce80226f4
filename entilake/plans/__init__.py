"""Queries over the data tables, made of the operators."""
