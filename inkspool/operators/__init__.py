"""Relational and array operators."""
