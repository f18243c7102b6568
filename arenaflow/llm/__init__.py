"""Training-data operators: one module per operator, plus the queries that apply
them to the ``documents`` table (``queries.py``).

Nothing else in the library imports this subpackage.
"""
