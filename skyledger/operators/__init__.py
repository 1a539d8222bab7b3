"""Relational operators and the model operators."""
