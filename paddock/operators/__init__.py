"""Reusable table operators: DataFrame in, DataFrame out."""
