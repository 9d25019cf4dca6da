"""Operators for preparing training data: one module per operator.

Nothing else in the library imports this package, and it can be deleted on its own.
"""
