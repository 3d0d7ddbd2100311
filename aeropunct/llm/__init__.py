"""Operators for preparing training text at scale, and the queries built on them."""
