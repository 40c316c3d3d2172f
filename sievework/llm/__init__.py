"""Operators for training text and conversations. Nothing else in the library imports this subpackage."""
