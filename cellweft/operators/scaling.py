"""Imputation, scaling and projection. Fitted numbers are one per column, applied as expressions."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import PCA, Imputer, OneHotEncoder, StringIndexer, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellweft.operators.quantiles import exact_percentiles
from cellweft.operators.stats import chunks, number
from cellweft.session import col

TEXT_MISSING = "missing"


def quartiles(df: DataFrame, features: list[str]) -> dict[str, tuple[float, float, float]]:
    """Exact 25, 50 and 75 % of each feature."""
    rows = exact_percentiles(df, [], features, [0.25, 0.5, 0.75]).collect()
    found = {(r["feature"], r["p"]): r["value"] for r in rows}
    return {f: (found.get((f, 0.25)), found.get((f, 0.5)), found.get((f, 0.75))) for f in features}


def moments(df: DataFrame, features: list[str]) -> dict[str, tuple[float, float]]:
    """Mean and population standard deviation of each feature."""
    out: dict[str, tuple[float, float]] = {}
    for part in chunks(features):
        row = df.agg(*[a for i, f in enumerate(part) for a in (
            F.avg(number(f)).alias(f"m{i}"), F.stddev_pop(number(f)).alias(f"s{i}"))]).first()
        out.update({f: (row[f"m{i}"], row[f"s{i}"]) for i, f in enumerate(part)})
    return out


def _replace(df: DataFrame, new: dict[str, Column]) -> DataFrame:
    return df.select(*[new[c].alias(c) if c in new else col(c) for c in df.columns])


def impute(df: DataFrame, features: list[str], strategy: str = "median") -> DataFrame:
    """NULL and NaN become the column's mean or exact median; a column without values becomes 0."""
    fill = ({f: q[1] for f, q in quartiles(df, features).items()} if strategy == "median"
            else {f: m[0] for f, m in moments(df, features).items()})
    return _replace(df, {f: F.coalesce(number(f), F.lit(float(fill[f] if fill[f] is not None else 0.0))) for f in features})


def robust_scale(df: DataFrame, features: list[str]) -> DataFrame:
    """(x - median) / (q75 - q25); a zero range divides by 1."""
    q = quartiles(df, features)
    return _replace(df, {f: (number(f) - F.lit(float(q[f][1] or 0.0))) / F.lit(float((q[f][2] or 0) - (q[f][0] or 0)) or 1.0)
                         for f in features})


def standard_scale(df: DataFrame, features: list[str]) -> DataFrame:
    """(x - mean) / population standard deviation; a zero deviation divides by 1."""
    m = moments(df, features)
    return _replace(df, {f: (number(f) - F.lit(float(m[f][0] or 0.0))) / F.lit(float(m[f][1] or 0.0) or 1.0)
                         for f in features})


def assemble(df: DataFrame, features: list[str], name: str = "features") -> DataFrame:
    safe = df.select("*", *[col(f).cast("double").alias(f"__f{i}") for i, f in enumerate(features)])
    out = VectorAssembler(inputCols=[f"__f{i}" for i in range(len(features))], outputCol=name,
                          handleInvalid="keep").transform(safe)
    return out.drop(*[f"__f{i}" for i in range(len(features))])


def project(df: DataFrame, features: list[str], k: int = 2) -> DataFrame:
    """PC1..PCk of already centred or raw features; means are taken off first, signs are free."""
    means = moments(df, features)
    centred = assemble(df.withColumns({f"__c{i}": col(f) - F.lit(float(means[f][0] or 0.0))
                                       for i, f in enumerate(features)}), [f"__c{i}" for i in range(len(features))], "__x")
    model = PCA(k=min(k, len(features)), inputCol="__x", outputCol="__pc").fit(centred)
    scores = model.transform(centred).withColumn("__a", vector_to_array("__pc"))
    out = scores.withColumns({f"PC{i + 1}": F.col("__a")[i] for i in range(min(k, len(features)))})
    if len(features) < k:
        out = out.withColumns({f"PC{i + 1}": F.lit(0.0) for i in range(len(features), k)})
    return out.drop("__x", "__pc", "__a", *[f"__c{i}" for i in range(len(features))])


def numeric_stages(features: list[str], strategy: str = "mean") -> list:
    """Spark ML stages for saved models: impute, assemble, standardise.

    Spark divides by the n-1 deviation, a constant factor no tree or penalty choice depends on.
    """
    filled = [f"{f}__filled" for f in features]
    return [Imputer(strategy=strategy, inputCols=features, outputCols=filled),
            VectorAssembler(inputCols=filled, outputCol="raw_features", handleInvalid="keep"),
            StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True)]


def one_hot(df: DataFrame, columns: list[str]) -> DataFrame:
    """Optional categorical context: missing becomes its own category, unseen values all zero."""
    filled = df.fillna(TEXT_MISSING, subset=columns)
    stages = [StringIndexer(inputCols=columns, outputCols=[f"{c}__i" for c in columns], handleInvalid="keep"),
              OneHotEncoder(inputCols=[f"{c}__i" for c in columns], outputCols=[f"{c}_hot" for c in columns],
                            dropLast=False, handleInvalid="keep")]
    return Pipeline(stages=stages).fit(filled).transform(filled).drop(*[f"{c}__i" for c in columns])
