"""Row identity, cell keys and seeded hash order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cellweft.session import col
from cellweft.settings import CELL_KEY


def cell_key(columns: tuple[str, ...] | list[str] = CELL_KEY) -> Column:
    """Struct of texts: NULL parts match each other, -0.0 equals 0.0, and one hash partitioning
    on it serves both grouping and joining."""
    parts = []
    for i, name in enumerate(columns):
        value = col(name)
        text = value.cast("string") if i == 0 else F.coalesce(
            (value.try_cast("double") + F.lit(0.0)).cast("string"), value.cast("string"))
        parts.append(text.alias(f"k{i}"))
    return F.struct(*parts)


def seeded(seed: object, key: Column | str = "row_key", *more: Column | str) -> Column:
    """md5 of the seed and the row key: the order every random choice is made in."""
    extra = [m if isinstance(m, Column) else F.lit(m) for m in more]
    return F.md5(F.concat(F.lit(f"{seed}-"), *extra, col(key) if isinstance(key, str) else key))
