"""Operators for preparing training corpora: one module per operator, queries and SQL in ``queries``."""
