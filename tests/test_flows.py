"""The three dataflows end to end on the smallest test data."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from cellweft.plans import recovery, supervised, tables
from cellweft.settings import Options, X, Y
from cellweft.sources import catalog


@pytest.fixture(scope="module")
def prepared(quant):
    return tables.prepare(quant, Options())


def test_prepare(quant, prepared):
    out = prepared.table
    assert out.count() == quant.count()
    assert set(out.columns) == set(catalog.boost_columns(quant.columns, Options()))
    assert prepared.label_counts.count() == 4
    gates = {r["feature"]: r for r in prepared.gating_summary.collect()}
    for name, gate in gates.items():
        low = out.agg(F.min(F.col(f"`{name}`"))).first()[0]
        assert low >= gate["threshold"] - 1e-9
    assert {r["label"] for r in prepared.unmatched.collect()} == {"FOXP3+"}
    assert not out.filter(F.col("Classification").contains("FOXP3")).limit(1).count()
    assert prepared.boxcox_record.count() == len(gates)


def test_prepare_needs_labels(quant):
    with pytest.raises(ValueError, match="no labels"):
        tables.prepare(quant.withColumn("Classification", F.lit(None).cast("string")))


def test_prepare_without_gating_with_power(quant):
    out = tables.prepare(quant, Options(run_gating=False, run_power=True, use_boxcox=False))
    assert out.boxcox_record is None
    assert out.gating_summary.filter("threshold is not null").count() == 0
    assert out.table.count() == quant.count()


def test_supervised(quant):
    options = Options(cv_splits=2, context_columns=("Image", X, Y, "ROI"))
    out = supervised.run(quant, options, draws=1)
    assert {r["marker"] for r in out.skipped.collect()} >= {"FOXP3"}
    found = {r["marker"] for r in out.registry.collect()}
    assert {"CD3", "CD8"} <= found
    assert {r["model"] for r in out.leaderboard.filter("marker = 'CD3'").collect()} == {
        "RandomForest", "ForestNoBootstrap", "LogisticRegression"}
    keys = quant.select("Image", X, Y).distinct().count()
    assert out.predictions.count() == quant.count() * len(found)
    assert out.merged.count() == keys == out.final.count()
    assert out.final.columns[:4] == ["Image", X, Y, "ROI"]
    assert out.final.filter("ROI is null").count() == 0
    wrong = out.predictions.filter("marker = 'CD3' and prediction not in (0, 1)").count()
    assert wrong == 0


@pytest.mark.parametrize("drop", [True])
def test_recovery(quant, drop):
    options = replace(Options(), recovery_marker="CD3", cv_splits=2, neighbours=10, drop_outliers=drop)
    out = recovery.run(quant, options, draws=1, trees=10, families=("RandomForest", "LogisticRegression"),
                       kmeans=(2,), mixtures=(2,), gate=drop)
    n = quant.count()
    assert out.predictions.count() == n
    assert out.abundance.agg(F.sum(F.col("`CD3-`") + F.col("`CD3+`"))).first()[0] == n
    flagged = out.plane.agg(F.avg(F.col("is_outlier").cast("double"))).first()[0]
    assert 0 < flagged <= 0.05
    assert out.clusters.count() == 2
    best = out.leaderboard.first()
    assert best["model"] == out.winner.family and best["balanced_accuracy"] > 0.9
    summary = out.summary.first()
    assert summary["n_rows_total"] == n and len(summary["rows_per_file"]) == 4
    assert "test_f1" in out.winner.scores


def test_recovery_without_features(quant):
    with pytest.raises(ValueError, match="no feature column"):
        recovery.run(quant, Options())
