"""Plans of the document-corpus engine."""
