"""Operators for preparing training text at scale, one module per operator.

Nothing outside this package imports it.  ``labwire.llm.registry`` holds the
registered queries and their oracle SQL.
"""
