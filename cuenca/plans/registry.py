"""Registry of named queries: key → (Spark builder, oracle SQL).

A plan module declares a query with::

    @query("agg01_sales_by_store", sql="SELECT ...", ctes=("e_items",))
    def _(spark, sf_dir): ...

The key's prefix is the SURVEY §2 id in lower case. ``sql`` is the DuckDB
oracle over the same parquet tables; ``None`` means no SQL oracle exists and a
pytest brute-force/golden check covers the query instead.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from cuenca.plans.model import with_ctes
from cuenca.session import apply_core_conf


@dataclass(frozen=True)
class Entry:
    key: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Entry] = {}


def query(key: str, sql: str | None = None, ctes=()):
    def deco(fn):
        if key in REGISTRY:
            raise ValueError(f"duplicate query key {key}")

        def build(spark: SparkSession, sf_dir: str) -> DataFrame:
            apply_core_conf(spark)
            return fn(spark, sf_dir)

        build.__name__ = build.__qualname__ = key
        build.__doc__ = fn.__doc__
        REGISTRY[key] = Entry(key, build, with_ctes(ctes, sql) if sql else None)
        return fn
    return deco


PLAN_MODULES = (
    "projections", "filters", "joins", "subqueries", "aggregates", "cubes",
    "windows", "sorting", "scalars", "documents", "sources",
    "sinks", "quality", "warehouse", "balancing", "domain", "streams", "session_ops",
)


def load_all() -> dict[str, Entry]:
    import importlib
    for m in PLAN_MODULES:
        importlib.import_module(f"cuenca.plans.{m}")
    return REGISTRY
