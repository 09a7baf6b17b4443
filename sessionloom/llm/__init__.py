"""Operators on the text of conversations and documents. Nothing outside this package imports it."""
