"""Operators for preparing training text of language models, apart from the rest of the library."""
