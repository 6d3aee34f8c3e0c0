"""Named queries: a Spark callable and, where SQL can say the same, its SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    run: Run
    sql: str | None


ENTRIES: dict[str, Entry] = {}


def query(sql: str | None = None) -> Callable[[Run], Run]:
    """Register a function under its own name."""

    def register(run: Run) -> Run:
        if run.__name__ in ENTRIES:
            raise ValueError(f"query {run.__name__} is registered twice")
        ENTRIES[run.__name__] = Entry(run, sql)
        return run

    return register


def settled(column: str, digits: int = 6) -> Column:
    """A mean rounded for comparison. Sums differ in the last bits with the order of rows, and
    a mean of prices can lie exactly between two roundings. So the noise is rounded away four
    digits further down first, in decimals, and a tie then rounds the same way everywhere."""
    fine = F.col(column).cast(f"decimal(28,{digits + 4})")
    return F.round(fine, digits).cast("double")


def settled_sql(expression: str, digits: int = 6) -> str:
    return f"CAST(round(CAST({expression} AS DECIMAL(28,{digits + 4})), {digits}) AS DOUBLE)"
