"""Training rows per marker: one table keyed by marker, not one file per marker."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellweft.functions import labels as L
from cellweft.session import col
from cellweft.sources import catalog


def training_rows(df: DataFrame, label: str = "Classification", delimiter: str = "|",
                  keep: list[str] | None = None) -> DataFrame:
    """Each row once per signed label it carries, with the marker and its ``key_label``.

    ``conflict`` marks rows carrying both signs of the marker; their key ends in the later sign.
    """
    keep = keep if keep is not None else df.columns
    names = [col(k) for k in keep]
    # Each step reads the arrays of the one before, so no label text is cut up twice.
    parts = df.filter(col(label).isNotNull()).select(*names, L.tokens(col(label), delimiter).alias("__tokens"))
    each = parts.select(*names, "__tokens", F.explode(F.array_distinct(F.filter("__tokens", L.is_signed))).alias("__token"))
    marked = each.withColumn("__marker", L.marker_of(F.col("__token")))
    own = marked.withColumn("__own", L.own_tokens(F.col("__tokens"), F.col("__marker")))
    ends = lambda sign: F.exists("__own", lambda t: t.endswith(sign))
    return own.select(*names, F.col("__marker").alias("marker"), F.col("__token").alias("label"),
                      F.array_join("__own", "|").alias("key_label"), (ends("+") & ends("-")).alias("conflict"))


def marker_table(df: DataFrame, marker: str, label: str = "Classification", delimiter: str = "|") -> DataFrame:
    """Training rows of one marker with only its own columns."""
    columns = catalog.marker_columns(df.columns, marker, label)
    own = [c for c in ("row_key", "source_file") if c in df.columns]
    rows = training_rows(df.select(*dict.fromkeys(own + columns + [label])), label, delimiter,
                         list(dict.fromkeys(own + columns)))
    return rows.filter(F.col("marker") == marker)


def small_tables(df: DataFrame, label: str = "Classification", delimiter: str = "|", limit: int = 5) -> DataFrame:
    """(marker, n_columns, columns, small): markers whose training table has no features to speak of."""
    markers = (df.filter(col(label).isNotNull())
               .select(F.explode(L.signed_tokens(col(label), delimiter)).alias("t"))
               .select(L.marker_of(F.col("t")).alias("marker")).distinct())
    shared = [c for c in df.columns if any(w in c for w in ("key_", "Centroid", "Image", "ROI", label))
              and c != "row_key"] + ["key_label"]
    names = F.array(*[F.lit(c) for c in df.columns if c not in catalog.OWN_COLUMNS])
    start = lambda c: F.lower(F.trim(F.split(c, ":")[0]))
    own = F.filter(names, lambda c: F.contains(c, F.lit(":")) & (start(c) == F.lower("marker")))
    columns = F.array_sort(F.array_union(own, F.array(*[F.lit(c) for c in shared])))
    return markers.select("marker", F.size(columns).cast("long").alias("n_columns"),
                          F.array_join(columns, ",").alias("columns"), (F.size(columns) <= limit).alias("small"))


def class_guard(rows: DataFrame, n_features: dict[str, int] | None = None) -> DataFrame:
    """(marker, classes, reason): reason is NULL where the marker can be trained."""
    found = rows.groupBy("marker").agg(F.count_distinct("key_label").cast("long").alias("classes"))
    if n_features is None:
        features = F.lit(1)
    else:
        features = F.coalesce(F.create_map(*[x for m, n in n_features.items() for x in (F.lit(m), F.lit(n))])[
            F.col("marker")], F.lit(0)) if n_features else F.lit(0)
    reason = (F.when(F.col("classes") < 2, F.lit("fewer than two classes"))
              .when(features < 1, F.lit("no features")))
    return found.select("marker", "classes", reason.alias("reason"))
