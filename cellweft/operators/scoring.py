"""Scoring every cell with every marker's model in one pass over the union of tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellweft.functions.labels import sign_label
from cellweft.operators.search import transform
from cellweft.session import col


@dataclass(frozen=True)
class MarkerModel:
    marker: str
    model: object
    features: tuple[str, ...]


def missing_features(columns: list[str], model: MarkerModel) -> list[str]:
    return [f for f in model.features if f not in columns]


def _kept(keep: list[str]) -> list:
    """Kept columns as they came: a model's features are filled under their own names."""
    return [F.col(f"__keep{i}").alias(k) for i, k in enumerate(keep)]


def score(df: DataFrame, models: list[MarkerModel], keep: list[str]) -> DataFrame:
    """Long (keep..., marker, prediction, probability).

    A marker whose features are not all present gets NULL. Each cell is read once: models are
    chained as narrow transforms, then the columns are turned to rows; nothing is shuffled.
    """
    out = df.withColumns({f"__keep{i}": col(k) for i, k in enumerate(keep)})
    for i, m in enumerate(models):
        if missing_features(df.columns, m):
            out = out.withColumns({f"__p{i}": F.lit(None).cast("int"), f"__s{i}": F.lit(None).cast("double")})
            continue
        filled = out.withColumns({f: F.coalesce(col(f).cast("double"), F.lit(0.0)) for f in m.features})
        out = transform(m.model, filled).withColumnsRenamed({"prediction": f"__p{i}", "probability": f"__s{i}"})
    return out.select(*_kept(keep), F.inline(F.array(*[
        F.struct(F.lit(m.marker).alias("marker"), F.col(f"__p{i}").alias("prediction"),
                 F.col(f"__s{i}").alias("probability")) for i, m in enumerate(models)])))


def score_wide(df: DataFrame, models: list[MarkerModel], keep: list[str]) -> DataFrame:
    """One row per cell with ``Prediction_<marker>`` and ``Probability_<marker>``."""
    out = df.withColumns({f"__keep{i}": col(k) for i, k in enumerate(keep)})
    for i, m in enumerate(models):
        if missing_features(df.columns, m):
            out = out.withColumns({f"__p{i}": F.lit(None).cast("int"), f"__s{i}": F.lit(None).cast("double")})
            continue
        filled = out.withColumns({f: F.coalesce(col(f).cast("double"), F.lit(0.0)) for f in m.features})
        out = transform(m.model, filled).withColumnsRenamed({"prediction": f"__p{i}", "probability": f"__s{i}"})
    return out.select(*_kept(keep), *[c for i, m in enumerate(models) for c in (
        F.col(f"__p{i}").alias(f"Prediction_{m.marker}"), F.col(f"__s{i}").alias(f"Probability_{m.marker}"))])


def label_rows(df: DataFrame, model, marker: str, threshold: float = 0.5) -> DataFrame:
    """(..., predicted_label): the winner's probability cut at 0.5."""
    scored = transform(model, df)
    hit = (F.col("probability") >= threshold).cast("int")
    return scored.withColumn("predicted_label", sign_label(marker, hit))
