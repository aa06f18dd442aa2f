"""Derived input views, the registered queries and their SQL counterparts."""
