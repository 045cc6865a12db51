"""Registry of named queries: each has a Spark callable and, where SQL can
express it on whole tables, an equivalent DuckDB oracle statement."""

from __future__ import annotations

from collections.abc import Callable

from faultline.fixtures import view_sql

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def oracle_text(views: list[str], ctes: list[tuple[str, str]], body: str) -> str:
    parts = [f"{n} AS (\n{view_sql(n, 'duckdb')}\n)" for n in views]
    parts += [f"{n} AS (\n{s.strip()}\n)" for n, s in ctes]
    head = ("WITH " + ",\n".join(parts) + "\n") if parts else ""
    return head + body.strip()


def register(name: str, *, views=(), ctes=(), sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = oracle_text(list(views), list(ctes), sql)
        return fn
    return deco
