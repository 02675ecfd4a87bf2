"""Operators of a training-data pipeline over raw documents, pages and vectors.

Nothing outside this subpackage imports it. Each module holds one operator with its own interface;
``queries`` derives the registered queries from them and ``oracle`` holds their SQL.
"""
