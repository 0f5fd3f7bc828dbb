"""Relational operators over daily relations."""
