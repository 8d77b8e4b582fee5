"""Operators of a training-data pipeline, one module per operator.

Nothing else in the library imports this subpackage. ``queries.registry()``
gives the registered ``opN_<name>`` queries and their DuckDB SQL.
"""
