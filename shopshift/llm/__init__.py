"""Operators for preparing training data (text, pages, conversations, vectors).

Nothing outside this package imports it: the registered queries are added by
``__spark_entry__.py`` when the package is present.
"""
