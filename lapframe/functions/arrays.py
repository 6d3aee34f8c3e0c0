"""Column expressions on arrays and flag columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F


def strip_prefix(name: str, prefix: str) -> str:
    return name[len(prefix):] if name.startswith(prefix) else name


def decode_flags(flags: Sequence[str], labels: Sequence[str], none_set: str | None = None) -> Column:
    """The label of the first greatest flag. Null flags count as 0.

    A row without any flag set gets the first label, or ``none_set`` when given.
    """
    values = F.array(*[F.coalesce(F.col(f"`{f}`").cast("double"), F.lit(0.0)) for f in flags])
    names = F.array(*[F.lit(label) for label in labels])
    best = F.element_at(names, F.array_position(values, F.array_max(values)).cast("int"))
    if none_set is None:
        return best
    return F.when(F.array_max(values) > 0, best).otherwise(F.lit(none_set))


def to_wide(array: Column, names: Sequence[str]) -> list[Column]:
    """One column per array position, null past the end."""
    return [F.get(array, F.lit(i)).alias(name) for i, name in enumerate(names)]
