"""Operators on text for language-model training data."""
