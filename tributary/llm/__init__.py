"""Operators of a training-data pipeline over a table of documents.

Nothing else in the library imports this subpackage.  Each module holds one
operator with its own general interface; ``queries.py`` registers one query
per operator and ``oracle.py`` the SQL of those that SQL can express.
"""
