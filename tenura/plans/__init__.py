"""Compositions of operators: data preparation, training, scoring."""
