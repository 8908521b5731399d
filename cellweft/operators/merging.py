"""Bringing predictions together on the cell key and adding context."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellweft.functions.keys import cell_key
from cellweft.operators.ranks import first_per_key
from cellweft.session import attach, col, settle
from cellweft.settings import CELL_KEY


def merge_predictions(long: DataFrame, markers: list[str], how: str = "inner",
                      key: tuple[str, ...] = CELL_KEY, value: str = "prediction",
                      ordinal: str = "row_key") -> DataFrame:
    """Long (key..., marker, prediction) to one row per key, ``Prediction_<marker>`` columns.

    De-duplication (first row of a key and marker) and the N-way join are one grouped aggregate:
    one shuffle whatever the number of markers, and a hot key folds map-side. NULL keys match.
    ``inner`` keeps keys that every marker has, ``outer`` keeps all.
    """
    first = [F.min(F.when(F.col("marker") == m, F.struct(col(ordinal).alias("o"), col(value).alias("v")))).alias(f"p{i}")
             for i, m in enumerate(markers)]
    grouped = long.groupBy(cell_key(key).alias("__key")).agg(
        *[F.min(col(k)).alias(k) for k in key], *first)
    if how == "inner":
        present = F.lit(True)
        for i in range(len(markers)):
            present = present & F.col(f"p{i}").isNotNull()
        grouped = grouped.filter(present)
    return grouped.select("__key", *[col(k) for k in key],
                          *[F.col(f"p{i}.v").alias(f"Prediction_{m}") for i, m in enumerate(markers)])


def join_context(merged: DataFrame, context: DataFrame, kept: list[str], key: tuple[str, ...] = CELL_KEY,
                 ordinal: str = "row_key") -> DataFrame:
    """Left join with the first context row of each key; keys first, kept context next, then the rest.

    Key columns missing from ``merged`` leave it unchanged; a context without the keys is skipped.
    Clashing names get ``_x``/``_y``.
    """
    usable = [k for k in key if k in merged.columns]
    if not usable or any(k not in context.columns for k in usable):
        return merged.drop("__key")
    extra = [c for c in dict.fromkeys(kept) if c in context.columns and c not in usable]
    left = merged if "__key" in merged.columns and tuple(usable) == tuple(key) else merged.withColumn(
        "__key", cell_key(usable))
    right = context.select(cell_key(usable).alias("__key"), col(ordinal).alias("__o"), *[col(c) for c in extra])
    right = first_per_key(right, [F.col("__key")], [F.col("__o")]).drop("__o")
    clash = [c for c in extra if c in merged.columns]
    left = left.withColumnsRenamed({c: f"{c}_x" for c in clash})
    right = right.withColumnsRenamed({c: f"{c}_y" for c in clash})
    out = left.join(right, "__key", "left").drop("__key")
    kept_now = [c for c in kept if c in out.columns and c not in usable]
    rest = [c for c in out.columns if c not in usable and c not in kept_now]
    return out.select(*[col(c) for c in usable + kept_now + rest])


def has_keys(columns: list[str], key: tuple[str, ...] = CELL_KEY) -> bool:
    return all(k in columns for k in key)


def unite_context(tables: list[DataFrame], kept: list[str], key: tuple[str, ...] = CELL_KEY,
                  ordinal: str = "row_key") -> DataFrame | None:
    """Context rows of all tables that have the keys."""
    out = None
    for t in tables:
        if not has_keys(t.columns, key):
            continue
        part = t.select(*dict.fromkeys([ordinal, *key, *[c for c in kept if c in t.columns]]))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def probability_intensity(predictions: DataFrame, intensities: DataFrame, value: str,
                          key: tuple[str, ...] = CELL_KEY, ordinal: str = "row_key") -> DataFrame:
    """Each measured cell with the prediction at its position (image, x, y).

    The first prediction of a key is used, so copies of a cell never multiply into pairs.
    """
    left = first_per_key(predictions.withColumn("__key", cell_key(key)), [F.col("__key")], [col(ordinal)])
    # Stored first: keys are unique on this side, and a join of two plain shuffles is one whose
    # skewed partitions (a position shared by very many cells) adaptive execution can split.
    left = settle(left.select("__key", "prediction", "probability"), "first-predictions")
    right = intensities.select(cell_key(key).alias("__key"), col(ordinal), *[col(k) for k in key],
                               col(value).alias("intensity"))
    return right.join(left, "__key", "inner").drop("__key")


def strip_index(name: str) -> str:
    """``Prediction_CD3_0`` to ``Prediction_CD3``."""
    parts = name.split("_")
    return "_".join(parts[:-1]) if name.startswith("Prediction") and len(parts) >= 3 else name


def prediction_name(marker: str, index: int) -> str:
    return f"Prediction_{marker}_{index}"


def prediction_table(table: DataFrame, marker: str, index: int, key: tuple[str, ...] = CELL_KEY) -> DataFrame:
    """The keys of one marker's table and its prediction, which is the fourth column; the text NA where there is none."""
    value = col(table.columns[3]) if len(table.columns) > 3 else F.lit("NA")
    return table.select(*[col(k) for k in key if k in table.columns], value.alias(prediction_name(marker, index)))


def inverted(df: DataFrame, value: str, group: list[str], name: str) -> DataFrame:
    """Group maximum minus the value: the maximum is an aggregate joined back, not a window, so a
    hot image is never sorted."""
    top = settle(df.groupBy(*[col(g) for g in group]).agg(F.max(col(value)).alias("__top")), "top")
    return attach(df, top, group).withColumn(name, F.col("__top") - col(value)).drop("__top")
