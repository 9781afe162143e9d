"""Operators for preparing language-model training data.

Each module holds one operator; `queries` registers them over the tables.
Nothing else in the library imports this package.
"""
