"""Operators for preparing training corpora: one module an operator, the queries in :mod:`gridloom.llm.queries`.

Nothing outside this subpackage imports it.
"""
