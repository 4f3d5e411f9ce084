"""Operators for large-scale training text; nothing else in the library imports this subpackage."""
