"""Operators of a training-data pipeline over a table of documents.

Each module holds one operator with its own interface; ``registry`` holds
the thin queries and their SQL. Nothing outside this subpackage imports it.
"""
