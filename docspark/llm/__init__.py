"""Operators for preparing text corpora for model training.

Each module holds one operator and the registered query that applies it to its whole table. Nothing outside this
subpackage imports it; ``queries`` collects the registered queries and their DuckDB oracles.
"""
