"""Label functions on edge values, boosting and training rules."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cellweft.functions import labels as L
from cellweft.operators import boosting, counts, merging, training
from cellweft.queries.fixtures import CELL_OPTIONS, KEY, MARKERS
from cellweft.settings import Options
from cellweft.sources.cells import BASIC

TEXTS = [None, "", "A+|", " A+ | B- ", "A+|A+", "CD3", "A+|A-", "CD3+|CD31+", "cd3+|CD3-", "CD45RO+|CD45-"]


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "i int, label string")


def column(df, value):
    return [r["v"] for r in df.orderBy("i").select(value.alias("v")).collect()]


def test_tokens(texts):
    got = column(texts, L.tokens(F.col("label")))
    assert got[0] is None and got[1] == [""] and got[2] == ["A+", ""] and got[3] == ["A+", "B-"]


def test_parse_last_wins(texts):
    assert column(texts, L.parse_marker(F.col("label"), "A")) == [None, None, 1, 1, 1, None, 0, None, None, None]
    assert column(texts, L.parse_marker(F.col("label"), "CD3")) == [None] * 7 + [1, 0, None]
    assert column(texts, L.parse_map(F.col("label")))[6] == {"A": "-"}


def test_key_label_is_exact(texts):
    assert column(texts, L.key_label(F.col("label"), F.lit("CD3"))) == [
        "", "", "", "", "", "CD3", "", "CD3+", "cd3+|CD3-", ""]
    assert column(texts, L.key_label(F.col("label"), F.lit("CD45")))[9] == "CD45-"


def test_append_and_remove(texts):
    add = column(texts, L.append_tokens(F.col("label"), F.array(F.lit("B-"))))
    assert add[:5] == ["B-", "B-", "A+|B-", "A+|B-", "A+|B-"]
    gone = column(texts, L.remove_tokens(F.col("label"), F.array(F.lit("A+"))))
    assert gone[:5] == [None, "", "", "B-", ""] and gone[6] == "A-"


def test_summary_counts_rows_once(texts):
    got = {r["Label"]: r for r in counts.label_summary(texts, "label").collect()}
    assert got["A+"]["total"] == 4 and got["A+"]["+"] == 4 and got["A+"]["-"] == 0
    assert "CD3" not in got


def test_training_conflict(texts):
    rows = training.training_rows(texts, "label", keep=["i"]).filter("i = 6").collect()
    assert {(r["marker"], r["label"], r["key_label"], r["conflict"]) for r in rows} == {
        ("A", "A+", "A+|A-", True), ("A", "A-", "A+|A-", True)}


def test_boost_rules(cells):
    before = cells.select("row_key", "source_file", F.col("Classification").alias("old"))
    after = boosting.boost(cells, CELL_OPTIONS, BASIC, MARKERS).select("row_key", F.col("Classification").alias("new"), *BASIC)
    both = before.join(after, "row_key").withColumn("added", F.array_except(
        L.tokens(F.coalesce("new", F.lit(""))), L.tokens(F.coalesce("old", F.lit("")))))
    changed = both.filter(F.size("added") > 0)
    per = changed.select("source_file", F.explode("added").alias("l")).groupBy("source_file", "l").count().collect()
    assert per and all(r["count"] <= 8 and r["l"].endswith("-") for r in per)
    lost = both.filter(F.size(F.array_except(L.filled_tokens(F.coalesce("old", F.lit(""))),
                                             L.tokens(F.coalesce("new", F.lit(""))))) > 0)
    assert lost.count() == 0
    assert after.count() == cells.count()


def test_boost_options(cells):
    most = boosting.negative_targets(cells, Options(all_markers=True, add_only_missing=False), BASIC, MARKERS)
    assert {r["label"] for r in most.select("label").distinct().collect()} == {"CD3-", "CD8-", "CD31-", "NA2-"}
    loose = boosting.negative_targets(cells, Options(marker_match="contains", add_only_missing=False), BASIC, MARKERS)
    assert loose.count() == 0  # lower-case column names contain no upper-case marker


def test_literal_removal_keeps_signed_tokens(cells):
    literal = boosting.drop_unmatched(cells, Options(signed_removal=False), BASIC, MARKERS)
    assert literal.filter(F.col("Classification").contains("FOXP3+")).count() > 0
    assert boosting.drop_unmatched(cells, CELL_OPTIONS, BASIC, MARKERS).filter(
        F.col("Classification").contains("FOXP3")).count() == 0


def test_merge_null_keys(spark):
    rows = [("i", None, 1.0, "A", 1, "1"), ("i", None, 1.0, "A", 0, "2"), ("i", None, 1.0, "B", 0, "3"),
            ("i", 0.0, 1.0, "A", 1, "4"), ("i", -0.0, 1.0, "B", 1, "5"), ("j", 1.0, 1.0, "A", 1, "6")]
    long = spark.createDataFrame(rows, "Image string, x_um double, y_um double, marker string, prediction int, row_key string")
    inner = merging.merge_predictions(long, ["A", "B"], "inner", KEY)
    got = {(r["x_um"], r["Prediction_A"], r["Prediction_B"]) for r in inner.collect()}
    assert got == {(None, 1, 0), (0.0, 1, 1)}
    assert merging.merge_predictions(long, ["A", "B"], "outer", KEY).count() == 3
    context = spark.createDataFrame([("i", None, 1.0, "r1", "a"), ("i", None, 1.0, "r2", "b")],
                                    "Image string, x_um double, y_um double, ROI string, row_key string")
    joined = {r["x_um"]: r["ROI"] for r in merging.join_context(inner, context, ["ROI"], KEY).collect()}
    assert joined == {None: "r1", 0.0: None}
    clash = merging.join_context(inner.withColumn("ROI", F.lit("m")), context, ["ROI"], KEY)
    assert {"ROI_x", "ROI_y"} <= set(clash.columns)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.sampled_from(["A+", "A-", "B+", "", " C- ", "D"]), min_size=1, max_size=6))
def test_counts_do_not_depend_on_partitions(spark, parts):
    df = spark.createDataFrame([("f", "|".join(parts))] * 7 + [("g", None)], "source_file string, Classification string")
    a = sorted(map(tuple, counts.label_counts(df.repartition(5)).collect()))
    assert a == sorted(map(tuple, counts.label_counts(df.coalesce(1)).collect()))
    assert counts.token_counts(df).filter("file = 'f'").first()["label_count"] == 7 * len(parts)
