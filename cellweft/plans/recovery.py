"""Recovery of one marker: outliers, clusters, a searched classifier and labels for every row."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellweft.functions import labels as L
from cellweft.operators import clustering, metrics, outliers, reports, sampling, scaling, scoring, search
from cellweft.plans.tables import preprocess
from cellweft.session import col, settle
from cellweft.settings import Options
from cellweft.sources import catalog


@dataclass
class Recovery:
    gating_summary: DataFrame
    plane: DataFrame
    clusters: DataFrame
    leaderboard: DataFrame
    predictions: DataFrame
    abundance: DataFrame
    summary: DataFrame
    winner: search.Fitted | None


def run(df: DataFrame, options: Options = Options(), draws: int | None = None, gate: bool = False,
        trees: int = outliers.TREES, families: tuple[str, ...] = search.RECOVERY_FAMILIES,
        kmeans: tuple[int, ...] = (2, 3, 4, 5, 6), mixtures: tuple[int, ...] = (2, 3, 4, 5)) -> Recovery:
    """``gate`` is off because tables are gated once, upstream."""
    spark, marker = df.sparkSession, options.recovery_marker
    features = catalog.prefixed_columns(df.columns, marker, options.exclude_patterns, options.marker_match == "exact")
    if not features:
        raise ValueError(f"no feature column for marker {marker!r}")
    ids = [f"x{i:03d}" for i in range(len(features))]
    place = [c for c in catalog.position_columns(df.columns)]
    rows = df.select("row_key", "source_file", *[col(c) for c in place],
                     L.parse_marker(col(options.label_column), marker, options.delimiter).alias("label"),
                     *[F.coalesce(col(f).cast("double"), F.lit(0.0)).alias(i) for f, i in zip(features, ids)])
    rows, gating = preprocess(rows, ids, replace(options, run_gating=gate))
    rows = settle(rows, "recovery")
    known = rows.filter("label is not null").select("row_key", "source_file", "label", *ids)
    scaled = settle(scaling.robust_scale(scaling.impute(known, ids), ids), "scaled")
    flagged = settle(outliers.outliers(scaled, ids, options.contamination, options.neighbours, options.seed, trees)
                     .select("row_key", "source_file", "label", "is_outlier", *ids), "flagged")
    plane = reports.outlier_plane(flagged, ids, "label")
    clusters = clustering.search(flagged.filter("not is_outlier"), ids, "label", options.seed, kmeans, mixtures)

    data = metrics.class_weights(known.withColumn("label", F.col("label").cast("double")), "label")
    if options.drop_outliers:
        data = data.join(flagged.filter("is_outlier").select("row_key"), "row_key", "left_anti")
    data = sampling.group_split(data, "source_file", options.test_size, options.validation_size, options.seed)
    groups = data.filter("part = 'train'").select("source_file").distinct().count()
    if groups >= 3:
        n_folds = min(options.cv_splits, groups)
        dealt = sampling.group_folds(data.filter("part = 'train'"), "label", "source_file", n_folds)
    else:
        n_folds = 3
        dealt = sampling.row_folds(data.filter("part = 'train'"), "label", n_folds, options.seed)
    train = settle(dealt.withColumns({f"fold_{i}": F.col("fold") == i for i in range(n_folds)}), "train")
    val, test = data.filter("part = 'validation'"), data.filter("part = 'test'")
    fitted = search.search_families(
        train, [f"fold_{i}" for i in range(n_folds)], search.recovery_draws(draws or options.draws, families), ids,
        options.seed, "pr_auc", "median", "weight", True)
    search.evaluate(fitted, val, test)
    board = metrics.leaderboard(search.board(spark, marker, fitted))
    best = search.choose_by_rank(fitted)
    if best is None:
        raise ValueError("no model family could be fitted")
    labelled = settle(scoring.label_rows(rows, best.model, marker), "labelled")
    marked = labelled.join(flagged.select("row_key", "is_outlier"), "row_key", "left")
    return Recovery(gating, plane, clusters, board, labelled, reports.abundance(labelled, marker),
                    reports.run_summary(marked, marker, "label", "is_outlier", best.family), best)
