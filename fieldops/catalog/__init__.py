"""Registered queries over the driver tables.

Each entry is ``(spark, sf_dir) -> DataFrame`` plus, where the operator is expressible in plain SQL,
an independent DuckDB oracle over the same parquet files (views named after the tables).  Keys are
the SURVEY IDs plus a slug.  Output columns carry explicit aliases shared with the oracle.
"""
from __future__ import annotations

import importlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass
class Entry:
    name: str
    fn: QueryFn
    sql: str | None


REGISTRY: dict[str, Entry] = {}

MODULES = (
    "basic", "cleaning", "joins", "aggregation", "windows", "scalars", "calendar_q",
    "supply", "service", "helpdesk", "vending", "dims", "ledger_q",
    "quality_q", "stateful",
)


# IDs whose work is the same query as another ID's entry (registered once all modules are loaded).
ALIASES = {
    "s09_starts_with": "b09_starts_with", "s12_safe_divide": "e19_safe_ratio_of_sums",
    "s22_generate_date_array": "t08_month_spine", "s24_injected_today": "b17_as_of_predicate",
    "g03_top1_per_group": "f01_top1_per_group", "g02_limit1_in_array": "b14_first_acceptable_token",
    "t03_business_hours_24h": "k29_sla_business_days_bonus", "t10_seasonal_window": "k12_stock_coverage",
}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Entry(name, fn, sql)
        return fn
    return deco


_loaded = False


def load_all() -> dict[str, Entry]:
    global _loaded
    if not _loaded:
        for m in MODULES:
            importlib.import_module(f"fieldops.catalog.{m}")
        for alias, target in ALIASES.items():
            if target and target in REGISTRY and alias not in REGISTRY:
                REGISTRY[alias] = Entry(alias, REGISTRY[target].fn, REGISTRY[target].sql)
        _loaded = True
    return REGISTRY


def queries() -> dict[str, QueryFn]:
    return {k: e.fn for k, e in load_all().items()}


def oracle_sql() -> dict[str, str]:
    return {k: e.sql for k, e in load_all().items() if e.sql}
