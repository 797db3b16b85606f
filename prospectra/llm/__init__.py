"""Operators for training data: documents, pages, conversations and a benchmark."""
