"""Operators for preparing training text; nothing else of the library imports this subpackage."""
