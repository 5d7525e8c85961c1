"""Operators for preparing training text: one module per operator.

Nothing outside this subpackage imports it. ``queries.QUERIES`` and
``queries.ORACLES`` hold the registered queries and their DuckDB SQL.
"""
