"""Functions of the document-corpus engine."""
