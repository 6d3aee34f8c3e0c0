"""Column expressions on strings."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def slug(name: Column) -> Column:
    """Trim, lower, drop dots, and turn spaces, dashes and slashes into underscores."""
    return F.translate(F.lower(F.trim(name)), " -/.", "___")


def first_int(text: Column, separator: str = "-") -> Column:
    """The number before the first separator: "2019-2021" gives 2019."""
    return F.split_part(text, F.lit(separator), F.lit(1)).try_cast("int")


def lat_lon(text: Column) -> tuple[Column, Column]:
    """Two doubles from "lat,lon"; null where either part is not a number."""
    parts = F.split(text, ",")
    return (
        F.trim(F.get(parts, F.lit(0))).try_cast("double"),
        F.trim(F.get(parts, F.lit(1))).try_cast("double"),
    )


def group_key(*columns: Column, separator: str = "_") -> Column:
    """A readable composite key. Joins use the columns themselves, not this string."""
    return F.concat_ws(separator, *[c.cast("string") for c in columns])
