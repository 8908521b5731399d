"""Label counts per file, label summaries and paired-marker sets.

Every count is a grouped aggregate with map-side partials, so one file that holds a third of all
rows adds no more shuffled rows than a small one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellweft.functions import labels as L
from cellweft.session import col

SOURCE = "source_file"
MAX_LABELS = 10_000  # columns of an export table


def exploded(df: DataFrame, label: str = "Classification", delimiter: str = "|",
             keep: tuple[str, ...] = (SOURCE,)) -> DataFrame:
    """One row per trimmed token; empty tokens included, NULL labels gone."""
    return df.filter(col(label).isNotNull()).select(
        *[col(k) for k in keep], F.explode(L.tokens(col(label), delimiter)).alias("label"))


def token_counts(df: DataFrame, label: str = "Classification", delimiter: str = "|",
                 files: DataFrame | None = None) -> DataFrame:
    """(file, label_count). A file without labels, or without the label column, counts 0."""
    if files is None:
        sized = F.when(col(label).isNull(), F.lit(0)).otherwise(F.size(L.tokens(col(label), delimiter)))
        return df.groupBy(col(SOURCE).alias("file")).agg(F.sum(sized).cast("long").alias("label_count"))
    counted = exploded(df, label, delimiter).groupBy(SOURCE).agg(F.count("*").alias("label_count"))
    full = files.select(SOURCE).join(counted, SOURCE, "left")
    return full.select(col(SOURCE).alias("file"), F.coalesce("label_count", F.lit(0)).cast("long").alias("label_count"))


def label_counts(df: DataFrame, label: str = "Classification", delimiter: str = "|") -> DataFrame:
    """Long (file, label, n); empty tokens dropped."""
    return (exploded(df, label, delimiter).filter(F.col("label") != "")
            .groupBy(col(SOURCE).alias("file"), "label").agg(F.count("*").cast("long").alias("n")))


def distinct_labels(df: DataFrame, label: str = "Classification", delimiter: str = "|") -> DataFrame:
    return label_counts(df, label, delimiter).select("label").distinct()


def label_table(df: DataFrame, label: str = "Classification", delimiter: str = "|",
                labels: list[str] | None = None, files: DataFrame | None = None) -> DataFrame:
    """Export form (file, one column per label in sorted order), zero-filled.

    The labels become column names, so the list is read from the long counts unless it is given.
    """
    counts = label_counts(df, label, delimiter)
    if labels is None:
        labels = sorted(r[0] for r in counts.select("label").distinct().limit(MAX_LABELS + 1).collect())
        if len(labels) > MAX_LABELS:
            raise ValueError(f"more than {MAX_LABELS} labels; use label_counts, the long form")
    every = (files if files is not None else df).select(col(SOURCE).alias("file")).distinct()
    wide = counts.groupBy("file").agg(
        *[F.coalesce(F.sum(F.when(F.col("label") == v, F.col("n"))), F.lit(0)).alias(v) for v in labels])
    return every.join(wide, "file", "left").select(
        "file", *[F.coalesce(col(v), F.lit(0)).cast("long").alias(v) for v in labels])


def total_labels(counts: DataFrame) -> DataFrame:
    return counts.agg(F.coalesce(F.sum("label_count"), F.lit(0)).cast("long").alias("total"))


def require_labels(counts: DataFrame) -> int:
    """The gate before any labelling work: no label at all is an error."""
    total = total_labels(counts).first()["total"]
    if total <= 0:
        raise ValueError("no labels in any table")
    return total


def label_summary(df: DataFrame, label: str = "Classification", delimiter: str = "|") -> DataFrame:
    """(Label, total, +, -) over signed tokens, each counted once per row."""
    one = df.filter(col(label).isNotNull()).select(
        F.explode(L.signed_tokens(col(label), delimiter)).alias("Label"))
    return one.groupBy("Label").agg(
        F.count("*").cast("long").alias("total"),
        F.sum(F.when(F.col("Label").endswith("+"), 1).otherwise(0)).cast("long").alias("+"),
        F.sum(F.when(F.col("Label").endswith("-"), 1).otherwise(0)).cast("long").alias("-"))


def marker_pairs(labels: DataFrame) -> DataFrame:
    """(marker, has_plus, has_minus, paired) from a table of distinct labels."""
    signed = labels.filter(L.is_signed(F.col("label")))
    pairs = signed.groupBy(F.expr("substring(label, 1, length(label) - 1)").alias("marker")).agg(
        F.max(F.col("label").endswith("+")).alias("has_plus"),
        F.max(F.col("label").endswith("-")).alias("has_minus"))
    return pairs.withColumn("paired", F.col("has_plus") & F.col("has_minus"))


def rows_per_file(df: DataFrame) -> DataFrame:
    return df.groupBy(SOURCE).agg(F.count("*").cast("long").alias("n_rows"))


def crosstab(df: DataFrame, row: str, column: str, values: list[str]) -> DataFrame:
    """Counts of ``row`` x ``column``; ``values`` fixes the output columns."""
    return df.groupBy(row).agg(*[F.sum(F.when(col(column) == v, 1).otherwise(0)).cast("long").alias(v)
                                 for v in values])
