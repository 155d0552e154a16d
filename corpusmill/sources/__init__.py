"""Sources of the document-corpus engine."""
