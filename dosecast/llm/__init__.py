"""Operators for training-data pipelines over the document, page and conversation tables."""
