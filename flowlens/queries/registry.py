"""Registered queries, each with the SQL that gives the same rows where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# Named sub-queries over the supplied tables: the logical inputs of FIXTURES.md in SQL, and shared steps.
_PARTS: dict[str, tuple[tuple[str, ...], str]] = {}


def part(name: str, text: str, *needs: str) -> None:
    _PARTS[name] = (needs, text)


def sql(body: str, *needs: str) -> str:
    """Query text with the named sub-queries it needs in front."""
    order: list[str] = []

    def add(name: str) -> None:
        if name not in order:
            for n in _PARTS[name][0]:
                add(n)
            order.append(name)

    for n in needs:
        add(n)
    if not order:
        return body
    head = ",\n".join(f"{n} AS (\n{_PARTS[n][1]}\n)" for n in order)
    return f"WITH {head}\n{body}"


def query(name: str, oracle: str | None = None, needs: tuple[str, ...] | str = ()):
    def add(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = sql(oracle, *((needs,) if isinstance(needs, str) else needs))
        return fn

    return add
