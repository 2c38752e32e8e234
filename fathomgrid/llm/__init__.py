"""Operators on texts and people for training corpora; nothing outside imports this package."""
