"""Registry of query builders and their SQL oracles."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from vigil.schemas import CLASS_NAMES, SENSITIVE_CLASSES
from vigil.sources.tables import table

Builder = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Builder] = {}
ORACLES: dict[str, str] = {}
OPS: dict[str, str] = {}

_MODULES = ("moderation", "envelopes", "curation", "features", "batches", "evaluation",
            "streams", "models", "scoring")


def query(name: str, ops: str, oracle: str | None = None) -> Callable[[Builder], Builder]:
    def register(fn: Builder) -> Builder:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        OPS[name] = ops
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        return fn
    return register


def load_all() -> None:
    for m in _MODULES:
        importlib.import_module(f"vigil.plans.{m}")


def t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return table(spark, sf_dir, name)


# --- SQL fragments shared by the oracles (DuckDB dialect) ---------------------------

def sql_pct(expr: str, seed: int = 42) -> str:
    """Stable bucket 0..99, the DuckDB form of ``operators.split.hash_percentile``."""
    return f"({sql_position(expr, seed)} % 100)"


def sql_position(expr: str, seed: int = 42) -> str:
    """The DuckDB form of ``operators.split.hash_position``."""
    return f"CAST(('0x' || substr(md5('{seed}:' || CAST({expr} AS VARCHAR)), 1, 8)) AS UBIGINT)"


def sql_hash_split(expr: str) -> str:
    p = sql_position(expr)
    return f"(CASE WHEN {p} < 0.7 * 4294967296 THEN 'train' WHEN {p} < 0.85 * 4294967296 THEN 'val' ELSE 'test' END)"


SQL_CLASS_LIST = str(CLASS_NAMES)
SQL_SENSITIVE_LIST = str(SENSITIVE_CLASSES)
SQL_URL_PATH = r"regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)', 1)"
SQL_URL_SEGS = f"list_filter(string_split({SQL_URL_PATH}, '/'), lambda s: s <> '')"
SQL_URL_LABEL = f"coalesce({SQL_URL_SEGS}[1], '')"
