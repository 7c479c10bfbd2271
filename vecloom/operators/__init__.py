"""Relational operators over text, vectors, stores and events."""
