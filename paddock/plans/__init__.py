"""Whole queries put together from the operators: marts, features, training, scoring."""
