"""Reading odd directories of tables, and the catalog."""

import math

import pytest
from pyspark.sql import functions as F

from cellweft.operators import counts
from cellweft.sources import catalog, manifest, tables
from cellweft.settings import Options, X, Y


@pytest.fixture(scope="module")
def dataset(tmp_path_factory):
    root = tmp_path_factory.mktemp("dataset")
    lines = {
        "s 1.tsv": [
            f"Image\t{X}\t{Y}\tClassification\tCD3: Cell: Median\tCD31: Cell: Median\tA.b: Cell: Std.Dev.",
            "i1\t1.5\t2\tCD3+| CD31- \t1\t2\t3", "i1\t1.5\t2\tA+|\tx\tInfinity\t-2", "i1\t\t4\tNA\t3\t1e3\t0",
            "i1\t5\t6\t\tNaN\t7\t0", "i1\t7\t8\tNone\t3\t7\t0", "i1\t9\t9\tCD3\t3\t7\t0"],
        "a+b.tsv": [
            f"CD8: Cell: Median (a.u.)\tCentroid Y um\tCentroid X um\tImage\t Classification ",
            "7\t2\t1\ti2\tCD8+|CD8-|CD8+", "8\t3\t2\ti2\tCD45RO+|CD45-"],
        "nolabel.tsv": [f"Image\t{X}\t{Y}\tCD8: Cell: Median", "i3\t1\t1\t4"],
    }
    for name, rows in lines.items():
        (root / name).write_text("\n".join(rows) + "\n", encoding="utf-8")
    (root / "notes.txt").write_text("not a table")
    (root / "empty.tsv").write_text("")
    (root / "blank.tsv").write_text("\n\n")
    return str(root)


def rows_of(df):
    return sorted(df.collect(), key=lambda r: r["ordinal"])


def test_mixed_headers(spark, dataset):
    t = tables.read_quant(spark, dataset, drop_parentheses=True)
    assert t.count() == 9
    by_file = {}
    for r in rows_of(t):
        by_file.setdefault(r["source_file"], []).append(r)
    assert set(by_file) == {"s 1.tsv", "a+b.tsv", "nolabel.tsv"}
    assert [r["CD8: Cell: Median"] for r in by_file["a+b.tsv"]] == [7.0, 8.0]
    assert [r[X] for r in by_file["a+b.tsv"]] == [1.0, 2.0]
    assert by_file["a+b.tsv"][0]["Classification"] == "CD8+|CD8-|CD8+"
    assert by_file["nolabel.tsv"][0]["Classification"] is None
    first = by_file["s 1.tsv"]
    assert [r["Classification"] for r in first] == ["CD3+| CD31- ", "A+|", None, None, None, "CD3"]
    assert first[1]["CD3: Cell: Median"] is None and math.isinf(first[1]["CD31: Cell: Median"])
    assert first[2][X] is None and first[3]["CD3: Cell: Median"] is None
    assert t.select("row_key").distinct().count() == 9


def test_keys_do_not_depend_on_pruning(spark, dataset):
    a = tables.read_quant(spark, dataset).select("row_key").collect()
    b = tables.read_quant(spark, dataset, columns=["Image"]).select("row_key").collect()
    assert set(a) == set(b)


def test_missing_label_modes(spark, dataset):
    with pytest.raises(ValueError, match="missing"):
        tables.read_quant(spark, dataset, missing_label="fail")
    t = tables.read_quant(spark, dataset)
    n = {r["file"]: r["label_count"] for r in counts.token_counts(t, files=tables.files_of(spark, dataset)).collect()}
    assert n == {"s 1.tsv": 5, "a+b.tsv": 5, "nolabel.tsv": 0, "empty.tsv": 0, "blank.tsv": 0}
    wide = {r["file"]: r.asDict() for r in counts.label_table(t).collect()}
    assert wide["nolabel.tsv"]["CD8+"] == 0 and wide["a+b.tsv"]["CD8+"] == 2
    assert "" not in wide["s 1.tsv"] and wide["s 1.tsv"]["A+"] == 1
    assert [c for c in counts.label_table(t).columns[1:]] == sorted(c for c in wide["s 1.tsv"] if c != "file")


def test_keys_do_not_depend_on_splits(spark, tmp_path):
    """Two files of some 2 MB with two headers, in one split each or in some twenty."""
    for name, head, tail in (("a.tsv", "Image\tCD3: Cell: Median", "i"), ("b.tsv", "\nCD3: Cell: Median\tImage", "7")):
        body = "\n".join(f"{tail}{i % 50}\t{i}" if name == "a.tsv" else f"{i}\t{tail}" for i in range(150_000))
        (tmp_path / name).write_text(f"{head}\n{body}\n")
    seen = []
    for size in ("64m", "200k"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "1k")
        t = tables.read_quant(spark, str(tmp_path))
        seen.append((t.rdd.getNumPartitions(), t.agg(
            F.count("*"), F.countDistinct("row_key"), F.sum(F.xxhash64("row_key", "source_file", "Image", F.col("`CD3: Cell: Median`"))
                                                            .cast("decimal(38,0)"))).first()))
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")
    assert seen[0][0] < seen[1][0] and seen[0][1] == seen[1][1] and seen[0][1][0] == seen[0][1][1] == 300_000


def test_all_columns_are_kept(spark, tmp_path):
    (tmp_path / "a.tsv").write_text('Image\tTissue\tTissue\tArea px\tCD3: Cell: Median\tCD3: Cell: Median\t\ni\tcore A\t2\t5\t1\t2\tz\ni\tNA\t3\tNA\tbad\t4\tz\n')
    (tmp_path / "b.tsv").write_text('Tissue\tImage\r\n"core ""B"""\tj\r\n\r\n')
    rows = rows_of(tables.read_quant(spark, str(tmp_path)))
    assert [r["Tissue"] for r in rows] == ["core A", None, 'core "B"'] and [r["Tissue.1"] for r in rows] == [2.0, 3.0, None]
    assert [r["Area px"] for r in rows] == [5.0, None, None]
    assert [r["CD3: Cell: Median"] for r in rows] == [1.0, None, None] and [r["CD3: Cell: Median.1"] for r in rows] == [2.0, 4.0, None]
    assert [r["Image"] for r in rows] == ["i", "i", "j"] and "" not in rows[0].asDict()


def test_header_names():
    assert tables.header_names("a\ta\ta.1\t\ta") == ["a", "a.1", "a.1.1", "", "a.2"]


def test_only_empty_files(spark, tmp_path):
    (tmp_path / "a.tsv").write_text("")
    assert tables.read_quant(spark, str(tmp_path)).count() == 0
    assert [tuple(r) for r in tables.files_of(spark, str(tmp_path)).collect()] == [("a.tsv", False)]
    with pytest.raises(ValueError, match="missing"):
        tables.read_quant(spark, str(tmp_path), missing_label="fail")


def test_empty_directory(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        tables.read_quant(spark, str(tmp_path))


def test_ingest_keeps_keys(spark, dataset, tmp_path):
    stored = tables.ingest(spark, dataset, str(tmp_path / "t"))
    assert stored.count() == 9
    assert set(stored.columns) == set(tables.read_quant(spark, dataset).columns)


def test_catalog_names(quant):
    f = {x.name: x for x in catalog.features(quant.columns)}
    assert f["CD3: Cytoplasm: Std.Dev."].compartment == "Cytoplasm" and f["CD3: Cell: Median"].stat == "Median"
    assert catalog.with_safe_ids(quant).columns[-1].startswith("f_00")
    assert catalog.prefixed_columns(quant.columns, "CD3") != catalog.prefixed_columns(quant.columns, "CD3", exact=False)
    assert not any(c.startswith("CD31") for c in catalog.prefixed_columns(quant.columns, "CD3"))
    assert catalog.intensity_columns(["A: Nucleus: Mean"], "CellObject") == []
    assert catalog.intensity_columns(["A: Nucleus: Mean"], "Detection") == ["A: Nucleus: Mean"]


def test_label_is_never_a_feature(quant):
    """The parsed label column starts with the marker's name."""
    with_label = quant.withColumn("CD3_label", F.lit(1))
    assert "CD3_label" not in catalog.prefixed_columns(with_label.columns, "CD3", exact=False)


def test_match_kinds(spark):
    labels = spark.createDataFrame([("CD3",), ("CD45",)], "marker string")
    cols = catalog.frame(spark, ["CD31: Cell: Median", "CD45RO: Cell: Median", "CD3: Nucleus: Median", "CD3: Cell: Median"])
    exact = {r["marker"]: r["original_name"] for r in catalog.match_columns(labels, cols).collect()}
    assert exact == {"CD3": "CD3: Cell: Median"}
    loose = {r["marker"]: r["original_name"] for r in catalog.match_columns(labels, cols, "contains").collect()}
    assert loose == {"CD3": "CD31: Cell: Median", "CD45": "CD45RO: Cell: Median"}


def test_manifest(spark, tmp_path):
    for name in ("img/s1/a.ome.tif", "img/s2/b.ome.tiff", "img/s2/skip.tif", "mask/a.ome_1.tif", "mask/a.ome_2.tif", "q/x_b.ome.tsv"):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text("x")
    lists = [manifest.list_files(spark, str(tmp_path / d)) for d in ("img", "mask", "q")]
    out = {r["key"]: r for r in manifest.build_manifest(*lists).collect()}
    assert set(out) == {"a.ome.tif", "b.ome.tiff"}
    assert out["a.ome.tif"]["segmask_path"].endswith("a.ome_1.tif") and out["a.ome.tif"]["quant_path"] is None
    assert out["b.ome.tiff"]["quant_path"].endswith("x_b.ome.tsv")
    twice = manifest.build_manifest(*lists, sample_in_key=True, earlier=manifest.build_manifest(*lists))
    assert twice.count() == 4 and "s1/a.ome.tif" in {r["key"] for r in twice.collect()}


def test_files_per_value(spark, tmp_path):
    df = spark.range(10_000, numPartitions=16).select(
        F.when(F.col("id") % 10 < 7, "hot").when(F.col("id") % 10 < 9, "mid").alias("v"), "id")
    tables.write_by(df, str(tmp_path / "t"), "v", rows=2000)
    files = {p.name: len(list(p.glob("*.parquet"))) for p in (tmp_path / "t").iterdir() if p.is_dir()}
    # 7,000, 2,000 and 1,000 rows; equal hashes may leave a file out, never add one.
    assert set(files) == {"v=hot", "v=mid", "v=__HIVE_DEFAULT_PARTITION__"}
    assert 2 <= files["v=hot"] <= 4 and files["v=mid"] == 1 and files["v=__HIVE_DEFAULT_PARTITION__"] == 1
    back = spark.read.parquet(str(tmp_path / "t"))
    assert back.count() == 10_000 and back.where("v is null").count() == 1000


def test_paths_are_named_by_split_not_by_line(spark, tmp_path):
    import re
    paths = ["/d/a.tsv", "/d/k=a b.tsv", "/d/k=a.tsv/part-0.csv", "/d/a.tsv/x.csv", "/d/.tsv", "/d/k=.tsv", "/d/a.tsv/p/part-1", "/a.tsv.gz"]
    assert [bool(re.search(tables.IS_TABLE, p)) for p in paths] == [bool(re.search(tables.TABLE_NAME, p)) for p in paths]
    (tmp_path / "a b.tsv").write_text("Image\tROI\nx\ty\n")
    data = tables.open_dataset(spark, str(tmp_path))
    assert [r["source_file"] for r in data.splits.collect()] == ["a b.tsv"]
    assert tables.read_quant(spark, str(tmp_path)).first()["source_file"] == "a b.tsv"


def test_a_task_writes_one_file(spark, tmp_path):
    df = spark.range(40_000, numPartitions=8).select((F.col("id") % 8).alias("v"), "id")
    tables.write_by(df, str(tmp_path / "t"), "v", rows=1000)
    # Part files are named by their task.
    tasks = [p.name.split("-")[1] for p in (tmp_path / "t").rglob("part-*.parquet")]
    assert len(tasks) == len(set(tasks)) == 40
    assert spark.read.parquet(str(tmp_path / "t")).count() == 40_000


def test_kept_features_stay_missing(spark):
    """A kept column that is also a feature is filled for the model only."""
    from cellweft.operators import scoring, search
    df = spark.createDataFrame([(str(i), float(i) if i % 5 else None, float(i % 7 > 3)) for i in range(60)], "row_key string, a double, label double")
    model = search._fit(df, "LogisticRegression", {"regParam": 1e-2, "maxIter": 5}, ["a"], 1, "mean", None)
    models = [scoring.MarkerModel("CD3", model, ("a",)), scoring.MarkerModel("CD8", model, ("b",))]
    for out in (scoring.score(df, models, ["row_key", "a"]).where("marker = 'CD3'"), scoring.score_wide(df, models, ["row_key", "a"])):
        assert out.where("a is null").count() == 12 and out.count() == 60


def test_sinks(spark, quant, tmp_path):
    small = quant.select("Image", F.array(F.lit(1.0)).alias("means")).limit(3)
    tables.write_csv(small, str(tmp_path / "c"))
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).first()["means"] == "[1.0]"
    assert Options().negative_cells == 8 and Options().label_column == "Classification"
