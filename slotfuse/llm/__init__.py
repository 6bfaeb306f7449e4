"""Operators for preparing training text for language models.

Nothing else in the library imports this package. `queries` registers one query per
operator; each operator module can be used on its own.
"""
