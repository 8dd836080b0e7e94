"""Operators of a training-data pipeline over a ``documents`` table.

Ten operators, one module each, and their registered queries in
``queries.py``. Nothing else in the library imports this subpackage.
"""
