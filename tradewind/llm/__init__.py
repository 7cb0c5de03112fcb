"""Operators for large text training corpora. Nothing else in the library imports this package."""
