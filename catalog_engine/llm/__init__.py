"""Operators for large text collections, one module each; nothing else in the library imports them."""
