"""Streaming of the document-corpus engine."""
