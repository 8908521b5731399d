"""Prepared tables to one table of predictions for every marker."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellweft.operators import merging, scoring, search, training
from cellweft.session import col, scratch_path, settle
from cellweft.settings import CELL_KEY, Options
from cellweft.sources import catalog


@dataclass
class Supervised:
    leaderboard: DataFrame
    registry: DataFrame
    skipped: DataFrame
    predictions: DataFrame
    merged: DataFrame
    final: DataFrame


def run(df: DataFrame, options: Options = Options(), context: DataFrame | None = None,
        key: tuple[str, ...] = CELL_KEY, draws: int | None = None, markers: list[str] | None = None) -> Supervised:
    """Training rows per marker, search, one scoring pass, merge on the cell key, context join."""
    spark = df.sparkSession
    names = catalog.features(df.columns)
    ids = {f.name: f.feature_id for f in names}
    by_marker: dict[str, list[str]] = {}
    for f in names:
        by_marker.setdefault(f.marker, []).append(f.feature_id)
    cells = settle(df.select(*[col(c).alias(ids.get(c, c)) for c in df.columns]), "cells")
    feature_ids = list(ids.values())
    rows = training.training_rows(cells, options.label_column, options.delimiter, ["row_key", *feature_ids])
    rows = settle(rows, "training", ("marker",))
    guard = settle(training.class_guard(rows, {m: len(v) for m, v in by_marker.items()}), "guard")
    # One row per marker.
    able = sorted(r["marker"] for r in guard.filter("reason is null").collect())
    able = [m for m in able if markers is None or m in markers]
    boards, models, entries = [], [], []
    for marker in able:
        features = by_marker[marker]
        own = rows.filter(F.col("marker") == marker)
        # A row with both signs stands in the set of both labels, as one row for its single key.
        fitted = search.train_marker(own, features, draws or options.supervised_draws, options.cv_splits, options.seed)
        boards.append(search.board(spark, marker, fitted))
        best = search.choose_by_f1(fitted)
        if best is None:
            continue
        path = scratch_path(spark, f"model-{len(entries)}")
        search.save_model(best, path)
        entries.append((marker, best, path, features))
        models.append(scoring.MarkerModel(marker, best.model, tuple(features)))
    board = boards[0] if boards else spark.createDataFrame([], search.BOARD)
    for b in boards[1:]:
        board = board.unionByName(b)
    keep = ["row_key", *key]
    found = [m.marker for m in models]
    long = settle(scoring.score(cells, models, keep), "predictions") if models else spark.createDataFrame(
        [], cells.select(*[col(k) for k in keep]).schema.add("marker", "string").add("prediction", "int")
        .add("probability", "double"))
    merged = merging.merge_predictions(long, found, "inner", key)
    final = merging.join_context(merged, context if context is not None else df, list(options.context_columns), key)
    return Supervised(board, search.registry(spark, entries), guard.filter("reason is not null"), long,
                      merged.drop("__key"), final)
