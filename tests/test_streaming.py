"""Streams equal batches, whatever the number of files a trigger takes."""

import pytest
from pyspark.sql import functions as F

from cellweft.operators import counts, stats
from cellweft.sources import tables
from cellweft.streaming import feeds

NAMES = ["Image", "Classification", "CD3: Cell: Median"]


@pytest.fixture(scope="module")
def folder(spark, quant, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("feed"))
    tables.write_tsv(quant.select("source_file", *[F.col(f"`{n}`") for n in NAMES]), path, ["source_file"])
    return path


def drain(spark, df, tmp_path, tag):
    feeds.write_complete(df, str(tmp_path / tag), str(tmp_path / f"{tag}-state")).awaitTermination()
    return spark.read.parquet(str(tmp_path / tag))


@pytest.mark.parametrize("per_trigger", [None, 1])
def test_stream_equals_batch(spark, quant, folder, tmp_path, per_trigger):
    stream = lambda: feeds.table_stream(spark, folder, NAMES, per_trigger)
    got = drain(spark, feeds.running_label_counts(stream()), tmp_path, "labels")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, counts.label_counts(quant).collect()))
    got = drain(spark, feeds.running_feature_stats(stream(), NAMES[2:]), tmp_path, "stats")
    want = {r["source_file"]: r for r in stats.running_stats(quant, ["source_file"], NAMES[2:]).collect()}
    for r in got.collect():
        assert r["n"] == want[r["source_file"]]["n"] and r["std"] == pytest.approx(want[r["source_file"]]["std"])


def test_other_header_fails(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.tsv").write_text("Image\tCD8: Cell: Median\ni\t1\n")
    q = feeds.write_complete(feeds.running_label_counts(feeds.table_stream(
        spark, str(tmp_path / "in"), ["Image", "Classification"])), str(tmp_path / "o"), str(tmp_path / "s"))
    with pytest.raises(Exception):
        q.awaitTermination()


def test_feed_has_files_by_rows(spark, tmp_path):
    """Files of a table grow with its rows, not with the tasks that write them: a batch takes a fixed number of files."""
    rows = spark.range(0, 4000, 1, 16).selectExpr("concat('b', id % 4, '.tsv') as source_file", "concat('a|', id) as Classification")
    tables.write_tsv(rows, str(tmp_path / "in"), ["source_file"], rows=500)
    files = list((tmp_path / "in").rglob("part-*.csv"))
    assert len(files) == 8
    got = drain(spark, feeds.running_label_counts(feeds.table_stream(spark, str(tmp_path / "in"), ["Classification"], 3)),
                tmp_path, "labels").where("label = 'a'")
    assert sorted(map(tuple, got.collect())) == [(f"b{i}.tsv", "a", 1000) for i in range(4)]


def test_query_feed_is_few_files(spark, monkeypatch):
    from cellweft.queries import streams
    seen = []
    monkeypatch.setattr(feeds, "table_stream", lambda s, path, *a, **k: seen.append(path))
    wide = streams.cells
    monkeypatch.setattr(streams, "cells", lambda s, d: wide(s, d).repartition(16))
    streams._stream(spark, "/root/testdata/sf0.001")
    assert spark.read.format("binaryFile").option("recursiveFileLookup", True).load(seen[0]).count() == 4


@pytest.mark.parametrize("path, name", [
    ("file:/d.tsv/k=v/x.tsv/part-0-c000.csv", "x.tsv"), ("file:/d/source_file=x%20y.tsv/part-0.csv", "x y.tsv"), ("x.tsv", "x.tsv"),
    ("/d/a.tsv/part-0.tsv", "a.tsv"), ("/d/b.csv/part-0.tsv", "part-0.tsv"), ("/a.tsv/b/part-0", ""), ("/a=b.tsv", "b.tsv")])
def test_table_name(spark, path, name):
    assert spark.createDataFrame([(path,)], "p string").select(tables.table_name(F.col("p"))).first()[0] == name
