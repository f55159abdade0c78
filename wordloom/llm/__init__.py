"""Operators for large collections of training text.  Nothing outside this folder imports it."""
