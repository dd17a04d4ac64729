"""The queries of the core by name, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from juriflow.queries import general, reference

Query = Callable[[SparkSession, str], DataFrame]

MODULES = [general, reference]


def queries() -> dict[str, Query]:
    return {name: q for m in MODULES for name, q in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in m.ORACLE.items()}
