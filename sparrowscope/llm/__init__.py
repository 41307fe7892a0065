"""Operators for preparing large text collections as training data.

Nothing else in the package imports this subpackage.
"""
