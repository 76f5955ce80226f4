"""Exports: filters and presets, triples and Turtle text, the line format, CSV files."""
