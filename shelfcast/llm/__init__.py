"""Operators of a training-data pipeline over text, pages and vectors; nothing else in the library imports them."""
