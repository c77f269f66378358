"""Query registry: name -> (callable(spark, sf_dir) -> DataFrame, DuckDB oracle SQL or None).

Each registered query reads the driver tables at ``sf_dir`` (whole tables)
and composes library operators.  The oracle SQL is the same computation
written independently in ANSI SQL for DuckDB; queries whose semantics are
iterative or randomised register ``sql=None`` (rows-only check).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..functions.kernels import nan_to_null
from ..session import read_table


@dataclass(frozen=True)
class Query:
    name: str
    fn: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    ops: tuple[str, ...]


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None = None, ops: tuple[str, ...] = ()):
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, sql, ops)
        return fn

    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table with NaN normalised to NULL: in the reference both are missing."""
    return nan_to_null(read_table(spark, sf_dir, name))


def load_all() -> dict[str, Query]:
    # importing the modules fills the registry
    from . import q_cleaning, q_profiling, q_charts, q_series, q_usage, q_models, q_io  # noqa: F401

    return REGISTRY
