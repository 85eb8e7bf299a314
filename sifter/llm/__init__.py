"""Operators for building training corpora, one module each; ``queries`` binds them to the tables."""
