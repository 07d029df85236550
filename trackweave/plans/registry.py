"""All registered queries of the track engine and their DuckDB counterparts."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

_QUERIES: dict[str, Callable] = {}
_ORACLES: dict[str, str] = {}
_MODULES = ("sequences", "coverage", "voting", "pooling", "comparing", "masks", "chunks", "ingest", "greedy", "identity", "streams")


def query(name: str, oracle: str | None = None) -> Callable:
    """Registers a (spark, sf_dir) -> DataFrame function, with SQL for DuckDB where SQL can say the same."""

    def add(f: Callable) -> Callable:
        _QUERIES[name] = f
        if oracle:
            _ORACLES[name] = oracle
        return f

    return add


def _load() -> None:
    for m in _MODULES:
        import_module(f"{__package__}.{m}")


def queries() -> dict[str, Callable]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_ORACLES)
