"""Compositions of operators over concrete tables."""
