"""Synthetic negative labels for the dimmest cells, and removal of labels nothing can measure."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellweft.functions import labels as L
from cellweft.functions.keys import seeded
from cellweft.operators import counts as C
from cellweft.operators.quantiles import exact_percentiles
from cellweft.operators.ranks import top_per_key
from cellweft.session import attach, col, settle
from cellweft.settings import Options
from cellweft.sources import catalog


def thresholds(df: DataFrame, columns: list[str], percentile: float) -> DataFrame:
    """(source_file, feature, threshold) at the low percentile of each median column."""
    return exact_percentiles(df, [C.SOURCE], columns, [percentile / 100.0]).select(
        C.SOURCE, "feature", F.col("value").alias("threshold"))


def negative_targets(df: DataFrame, options: Options, columns: list[str],
                     marker_names: dict[str, str] | None = None, files: DataFrame | None = None) -> DataFrame:
    """(source_file, label, feature, threshold): negatives to add per file.

    Candidates are the negative labels seen in any file (all catalog markers with
    ``all_markers``). With ``add_only_missing`` a file that has the label more than once is left
    alone. Labels without a column, and files without counts, get no target.
    """
    spark = df.sparkSession
    counts = settle(C.label_counts(df, options.label_column, options.delimiter), "counts")
    files = (df if files is None else files).select(col(C.SOURCE).alias("file")).distinct()
    shown = spark.createDataFrame(
        [(f"f_{i:04d}", c, (marker_names or {}).get(c, c.split(":")[0].strip())) for i, c in enumerate(columns)],
        "feature_id string, original_name string, marker string")
    negatives = counts.filter(F.col("label").endswith("-")).select("label").distinct()
    if options.all_markers:
        negatives = negatives.union(shown.select(F.concat("marker", F.lit("-")).alias("label"))).distinct()
    negatives = negatives.withColumn("marker", F.expr("substring(label, 1, length(label) - 1)"))
    matched = catalog.match_columns(negatives, shown, options.marker_match)
    # files x labels is metadata: one row per file and negative label.
    listed = matched.agg(F.collect_list(F.struct("label", "original_name")).alias("__l")).withColumn("__one", F.lit(1))
    each = attach(files.withColumn("__one", F.lit(1)), settle(listed, "negatives"), ["__one"], "inner").select(
        "file", F.inline("__l"))
    own = counts.select("file", "label", "n")
    wanted = each.join(own, ["file", "label"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    if options.add_only_missing:
        wanted = wanted.filter("n <= 1")
    limits = thresholds(df, columns, options.negative_percentile).filter("threshold is not null")
    return wanted.select(F.col("file").alias(C.SOURCE), "label", F.col("original_name").alias("feature")).join(
        limits, [C.SOURCE, "feature"])


def pick_cells(df: DataFrame, targets: DataFrame, columns: list[str], options: Options) -> DataFrame:
    """(source_file, label, row_key, rank): up to n cells at or below the threshold, in hash order.

    Each row meets only the targets of its own file; the rank filter keeps n rows per (file, label)
    in every map task before the shuffle.
    """
    limits = settle(targets.groupBy(C.SOURCE).agg(*[
        F.max(F.when(F.col("feature") == c, F.col("threshold"))).alias(f"__t{i}") for i, c in enumerate(columns)]), "limits")
    near = attach(df.select(C.SOURCE, "row_key", *[col(c).cast("double").alias(f"__v{i}") for i, c in enumerate(columns)]),
                  limits, [C.SOURCE], "inner")
    low = near.select(C.SOURCE, "row_key", F.inline(F.array(*[
        F.struct(F.lit(c).alias("feature"), (F.col(f"__v{i}") <= F.col(f"__t{i}")).alias("low"))
        for i, c in enumerate(columns)]))).filter("low").drop("low")
    wanted = settle(targets.groupBy(C.SOURCE, "feature").agg(F.collect_set("label").alias("__labels")), "wanted")
    low = attach(low, wanted, [C.SOURCE, "feature"], "inner").select(C.SOURCE, "row_key", F.explode("__labels").alias("label"))
    low = low.withColumn("__h", seeded(options.seed, "row_key", F.col("label")))
    return top_per_key(low, [F.col(C.SOURCE), F.col("label")], [F.col("__h"), F.col("row_key")],
                       options.negative_cells).drop("__h")


def boost(df: DataFrame, options: Options = Options(), columns: list[str] | None = None,
          marker_names: dict[str, str] | None = None, files: DataFrame | None = None) -> DataFrame:
    """Rows with the picked negative labels appended, in label order; other rows unchanged."""
    columns = columns or catalog.median_columns(df.columns)
    if not columns:
        return df
    targets = settle(negative_targets(df, options, columns, marker_names, files), "targets")
    picks = settle(pick_cells(df, targets, columns, options)
                   .groupBy("row_key").agg(F.array_sort(F.collect_set("label")).alias("__add")), "picks")
    label = col(options.label_column)
    return attach(df, picks, ["row_key"], salted=False).withColumn(
        options.label_column, F.when(F.col("__add").isNotNull(),
                                     L.append_tokens(label, F.col("__add"), options.delimiter)).otherwise(label)
    ).drop("__add")


def unmatched_tokens(df: DataFrame, options: Options, columns: list[str],
                     marker_names: dict[str, str] | None = None) -> DataFrame:
    """(marker, token): tokens of unpaired markers for which no column exists."""
    spark = df.sparkSession
    shown = spark.createDataFrame(
        [(f"f_{i:04d}", c, (marker_names or {}).get(c, c.split(":")[0].strip())) for i, c in enumerate(columns)],
        "feature_id string, original_name string, marker string")
    pairs = C.marker_pairs(C.distinct_labels(df, options.label_column, options.delimiter))
    lonely = pairs.filter("not paired").select("marker")
    matched = catalog.match_columns(lonely, shown, options.marker_match).select("marker")
    gone = lonely.join(matched, "marker", "left_anti")
    forms = (F.array(F.concat("marker", F.lit("+")), F.concat("marker", F.lit("-"))) if options.signed_removal
             else F.array(F.col("marker")))
    return gone.select("marker", F.explode(forms).alias("token"))


def unmatched_counts(df: DataFrame, tokens: DataFrame, options: Options) -> DataFrame:
    """(label, n): how often each unmatched token occurs."""
    seen = C.exploded(df, options.label_column, options.delimiter, keep=()).groupBy("label").agg(
        F.count("*").cast("long").alias("n"))
    return seen.join(tokens.select(F.col("token").alias("label")).distinct(), "label", "left_semi")


def drop_unmatched(df: DataFrame, options: Options = Options(), columns: list[str] | None = None,
                   marker_names: dict[str, str] | None = None) -> DataFrame:
    """Remove the unmatched tokens from every label; rows are replaced, never repeated."""
    columns = columns if columns is not None else catalog.median_columns(df.columns)
    # One row holding the token list: it has at most two entries per unpaired marker.
    listed = settle(unmatched_tokens(df, options, columns, marker_names).agg(
        F.array_sort(F.collect_set("token")).alias("__drop")).withColumn("__one", F.lit(1)), "unmatched")
    label = col(options.label_column)
    return attach(df.withColumn("__one", F.lit(1)), listed, ["__one"], max_values=100).withColumn(
        options.label_column, L.remove_tokens(label, F.col("__drop"), options.delimiter)).drop("__drop", "__one")
