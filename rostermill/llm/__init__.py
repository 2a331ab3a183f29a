"""Operators for training-data pipelines: documents, pages, vectors, chats."""
