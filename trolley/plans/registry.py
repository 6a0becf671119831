"""Query registry: name -> (spark, sf_dir) -> DataFrame, plus DuckDB oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


CATALOGUES = ("catalog_star", "catalog_clean", "catalog_mining", "catalog_layout",
              "catalog_forecast", "catalog_classify", "catalog_recommend", "catalog_quality", "catalog_cluster", "catalog_products")


def load_all():
    """Import every catalogue module (each registers its queries on import)."""
    import importlib
    for mod in CATALOGUES:
        try:
            importlib.import_module(f"trolley.plans.{mod}")
        except ModuleNotFoundError as e:
            if e.name != f"trolley.plans.{mod}":
                raise
    return QUERIES, ORACLE
