"""Operators for building training corpora.

Nothing outside this subpackage imports it.  Every module holds one operator with a general interface; ``queries``
holds the registered queries and their SQL.
"""
