"""Training-data operators: one module per operator, queries in ``queries``.

Nothing outside this package imports it; ``__spark_entry__`` adds its queries
only when it is present.
"""
