"""Operators for preparing text at corpus scale; nothing else in the library imports them."""
