"""Operators of the document-corpus engine."""
