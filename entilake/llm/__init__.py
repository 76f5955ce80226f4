"""Operators for training text: token counts, packing, mixing and language identification.

Nothing outside this folder imports it."""
