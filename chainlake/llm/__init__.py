"""Training-data operators: one module per operator, and ``catalog`` for their queries.

Nothing outside this folder imports it, except ``__spark_entry__.py`` behind a guard.
"""
