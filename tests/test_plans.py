"""The shapes of the plans that matter at scale."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from cellweft.functions.keys import cell_key
from cellweft.operators import boosting, counts, merging, ranks, stats
from cellweft.queries.fixtures import CELL_OPTIONS, KEY, MARKERS, scored
from cellweft.session import settle
from cellweft.sources.cells import BASIC, cells as make

from conftest import SF


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.fixture(scope="module")
def stored(spark):
    return settle(make(spark, SF), "cells")


def test_first_per_key_prunes_before_the_shuffle(stored):
    text = plan(ranks.first_per_key(stored, [cell_key(KEY)], [F.col("row_key")]))
    assert text.count("WindowGroupLimit") >= 2 and text.count("Exchange") <= 2


def test_boost_picks_prune_before_the_shuffle(stored):
    targets = settle(boosting.negative_targets(stored, CELL_OPTIONS, BASIC, MARKERS), "targets")
    text = plan(boosting.pick_cells(stored, targets, BASIC, CELL_OPTIONS))
    assert "WindowGroupLimit" in text and "BroadcastHashJoin" in text
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_merge_is_one_shuffle(spark):
    rows = settle(scored(spark, SF), "scored")
    text = plan(merging.merge_predictions(rows, ["CD3", "CD8"], "inner", KEY))
    assert text.split("\n\n")[0].count("Exchange") == 1


def test_context_join_reuses_the_grouping(spark, stored):
    rows = settle(scored(spark, SF), "scored")
    merged = merging.merge_predictions(rows, ["CD3", "CD8"], "inner", KEY)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(merging.join_context(merged, stored, ["source_file"], KEY))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # One exchange for the predictions, one for the context; the join adds none.
    assert text.split("\n\n")[0].count("Exchange") == 2


def test_scans_are_pruned(stored):
    text = plan(counts.label_counts(stored))
    assert "ReadSchema: struct<Classification:string,source_file:string>" in text or \
        "ReadSchema: struct<source_file:string,Classification:string>" in text
    text = plan(stats.running_stats(stored, ["source_file"], ["cd3_cell_median"]))
    assert "cd8_cell_median" not in text


def test_projections_stay_in_generated_code(stored):
    text = plan(stored.select(F.inline(F.array(*[F.struct(F.lit(b).alias("f"), F.col(b).alias("v")) for b in BASIC]))))
    assert "[codegen id" in text


def test_table_without_a_prediction(spark):
    from cellweft.operators import merging
    df = spark.createDataFrame([("i", 1.0, 2.0, 1)], "Image string, x double, y double, pred int")
    key = ("Image", "x", "y")
    assert merging.prediction_table(df, "CD3", 0, key).first().asDict() == {"Image": "i", "x": 1.0, "y": 2.0, "Prediction_CD3_0": 1}
    short = merging.prediction_table(df.drop("pred"), "CD8", 1, key)
    assert short.first().asDict() == {"Image": "i", "x": 1.0, "y": 2.0, "Prediction_CD8_1": "NA"}
