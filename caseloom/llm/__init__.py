"""Operators for training-text problems; nothing else in the library imports this subpackage."""
