"""Registry of named queries: a Spark builder and, where SQL can say the same,
the DuckDB oracle text (appended to ``sql_prelude()``)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from faultline.plans.context import LogContext, sql_prelude


@dataclass(frozen=True)
class Entry:
    name: str
    build: Callable[[LogContext], DataFrame]
    sql: str | None  # body after the shared WITH clause; may start with ",cte AS (...)"


REGISTRY: dict[str, Entry] = {}


def query(name: str, sql: str | None = None):
    def deco(fn: Callable[[LogContext], DataFrame]):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Entry(name, fn, sql)
        return fn
    return deco


def _load_all() -> None:
    # Importing the modules registers their queries.
    from faultline.plans import (  # noqa: F401
        q_clean, q_deepdive, q_firstpass, q_freq, q_relational, q_sequences,
    )


def spark_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load_all()

    def bind(e: Entry):
        return lambda spark, sf_dir: e.build(LogContext(spark, sf_dir))

    return {n: bind(e) for n, e in REGISTRY.items()}


def suite_queries(ctx: LogContext) -> dict[str, Callable[[], DataFrame]]:
    """The queries over one context, such as one whose cleaned log is persisted."""
    _load_all()
    return {n: (lambda e=e: e.build(ctx)) for n, e in REGISTRY.items()}


def oracle_queries() -> dict[str, str]:
    _load_all()
    pre = sql_prelude()
    out = {}
    for n, e in REGISTRY.items():
        if e.sql is None:
            continue
        body = e.sql.strip()
        out[n] = pre + ("\n" if body.startswith(",") else "\n") + body
    return out
