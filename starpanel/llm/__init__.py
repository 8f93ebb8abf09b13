"""Operators on training text and embeddings; nothing outside this subpackage imports it."""
