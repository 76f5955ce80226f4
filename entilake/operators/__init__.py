"""Relational and data-processing operators: DataFrame in, DataFrame out."""
