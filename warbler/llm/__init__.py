"""Operators for building training data from text, vectors, pages and conversations.

Nothing else in the library imports this subpackage. Each module holds one operator with its own
interface; ``queries`` registers one thin query per operator.
"""
