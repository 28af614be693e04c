"""Operators for training-data pipelines over the ``documents`` table.

Nothing else in the library imports this subpackage.
"""
