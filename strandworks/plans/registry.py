"""All named queries of the core, with their SQL where SQL can express them."""

from __future__ import annotations

from importlib import import_module

MODULES = ["nested_plans", "orphan_plans", "profile_plans", "search_plans", "catalog_plans", "evaluate_plans", "media_plans", "records_plans"]


def core_queries() -> dict:
    return {name: f for m in MODULES for name, f in import_module(f"{__package__}.{m}").QUERIES.items()}


def core_oracle() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in import_module(f"{__package__}.{m}").ORACLE.items()}
