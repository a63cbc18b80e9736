"""Operators for training-data pipelines over documents, pages and conversations.

Nothing else in the library imports this subpackage.
"""
