"""Operators for preparing language-model training corpora at scale.

Nothing else in the package imports this subpackage, and it imports nothing from the rest: it can be
removed as a whole.  Each module holds one operator with a general interface, the thin ``query`` that
applies it to a whole table, and ``ORACLE_SQL`` where DuckDB SQL can say the same.
"""
