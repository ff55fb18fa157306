"""Where named queries and their SQL are kept, and rounding that engines agree on."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def r6(c):
    return F.round(c, 6)


def off_grid(c):
    """Rounded to four digits from a point beside the decimal grid: sums of decimals often end in a tie, which engines that add in another order break differently."""
    return F.round(c + F.lit(1.37e-5), 4)
