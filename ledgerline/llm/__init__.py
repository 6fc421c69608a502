"""Operators of a training-data pipeline over documents and web pages.

Each module holds one operator with its own general interface; ``queries``
registers the thin queries over the given tables and ``oracle`` their SQL.
Nothing outside this folder imports it.
"""
