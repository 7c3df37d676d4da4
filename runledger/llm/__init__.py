"""Operators for preparing large text corpora (one module per operator)."""
