"""Sources and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellweft.functions import text
from cellweft.operators import boosting, counts, stats, training
from cellweft.queries.base import query, rounded
from cellweft.queries.fixtures import CELL_OPTIONS, MARKERS, written_tables
from cellweft.session import col, scratch_path
from cellweft.settings import X, Y
from cellweft.sources import manifest, tables
from cellweft.sources.cells import BASIC, cells, quant, table


@query("src_01_read_quant", """select source_file, "Image", "Centroid X µm" as x_um, "Centroid Y µm" as y_um,
    Classification, "CD3: Cell: Median" as cd3, "CD8: Cell: Mean" as cd8, "CD3: Cytoplasm: Std.Dev." as sd from quant""",
       "quant")
def read_quant(spark, d):
    t = tables.read_quant(spark, written_tables(spark, d))
    return t.select("source_file", "Image", col(X).alias("x_um"), col(Y).alias("y_um"), "Classification",
                    col("CD3: Cell: Median").alias("cd3"), col("CD8: Cell: Mean").alias("cd8"),
                    col("CD3: Cytoplasm: Std.Dev.").alias("sd"))


@query("src_02_pruned_scan", """select "Image", count(*) as n, round(sum("CD3: Cell: Median"), 6) as total
    from quant group by 1""", "quant")
def pruned_scan(spark, d):
    t = tables.read_quant(spark, written_tables(spark, d), columns=["Image", "CD3: Cell: Median"])
    return rounded(t.groupBy("Image").agg(F.count("*").alias("n"), F.sum(col("CD3: Cell: Median")).alias("total")))


@query("src_03_split_scan", """select source_file, count(*) as n, count(Classification) as n_labelled,
    max("CD8: Cell: Median") as top from quant group by 1""", "quant")
def split_scan(spark, d):
    t = tables.read_quant(spark, written_tables(spark, d))
    per_split = t.withColumn("split", F.spark_partition_id()).groupBy("source_file", "split").agg(
        F.count("*").alias("n"), F.count("Classification").alias("n_labelled"), F.max(col("CD8: Cell: Median")).alias("top"))
    return per_split.groupBy("source_file").agg(F.sum("n").alias("n"), F.sum("n_labelled").alias("n_labelled"),
                                                F.max("top").alias("top"))


@query("src_04_source_file", "select 'lineitem.parquet' as source_file, count(*) as n from lineitem", "")
def source_file(spark, d):
    t = table(spark, d, "lineitem")
    return t.select(text.decode_name(F.col("_metadata.file_name")).alias("source_file")).groupBy("source_file").agg(
        F.count("*").alias("n"))


@query("src_05_na_texts", """select o_orderkey, case when o_orderpriority like '1-%' or o_orderpriority like '5-%'
    or o_orderpriority like '3-%' then null else o_orderpriority end as priority from orders""", "")
def na_texts(spark, d):
    p = F.col("o_orderpriority")
    raw = F.when(p.startswith("1-"), "NA").when(p.startswith("5-"), " None ").when(p.startswith("3-"), "").otherwise(p)
    return table(spark, d, "orders").select("o_orderkey", text.na_to_null(raw).alias("priority"))


@query("src_06_clean_names", """select row_key, "Centroid X µm", "Centroid Y µm", "CD3: Cell: Median" from quant""", "quant")
def clean_names(spark, d):
    q = quant(spark, d).select("row_key", col(X).alias(" Centroid X um"), col(Y).alias("Centroid Y um "),
                               col("CD3: Cell: Median").alias("CD3: Cell: Median (a.u.)"))
    return tables.clean_names(q, True)


@query("src_07_missing_label", """select f.source_file as file, coalesce(n, 0) as label_count from files f left join
    (select source_file, count(*) as n from tok where source_file <> 'batch_3.tsv' group by 1) c
    on c.source_file = f.source_file""", "tok files")
def missing_label(spark, d):
    path = written_tables(spark, d, "batch_3.tsv")
    return counts.token_counts(tables.read_quant(spark, path), files=tables.files_of(spark, path))


@query("src_08_manifest", """select i.key, i.ome_path, min(m.path) as segmask_path, min(q.path) as quant_path from
    (select distinct concat(left(source_file, length(source_file) - 4), '/', Image, '.ome.tif') as key,
      concat('/images/', left(source_file, length(source_file) - 4), '/', Image, '.ome.tif') as ome_path,
      concat(Image, '.ome') as stem from cells) i
    left join (select distinct concat('/masks/', Image, '.ome_mask', cast(na2_cell_median > 2 as int), '.tif') as path
      from cells where Image <> 'img_3') m on contains(m.path, i.stem)
    left join (select distinct concat('/tables/', Image, '.ome.tsv') as path from cells) q on contains(q.path, i.stem)
    group by 1, 2""")
def build_manifest(spark, d):
    c = cells(spark, d)
    folder = F.expr("substring(source_file, 1, length(source_file) - 4)")
    images = c.select(F.concat(F.lit("/images/"), folder, F.lit("/"), "Image", F.lit(".ome.tif")).alias("path")).distinct()
    masks = c.filter("Image <> 'img_3'").select(F.concat(
        F.lit("/masks/"), "Image", F.lit(".ome_mask"), (F.col("na2_cell_median") > 2).cast("int"), F.lit(".tif")).alias("path")).distinct()
    quants = c.select(F.concat(F.lit("/tables/"), "Image", F.lit(".ome.tsv")).alias("path")).distinct()
    return manifest.build_manifest(images, masks, quants, True)


@query("snk_01_tsv", "select o_orderkey, o_custkey, o_orderpriority, o_totalprice from orders", "")
def tsv(spark, d):
    path = scratch_path(spark, "orders.tsv")
    tables.write_tsv(table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_totalprice"), path)
    return (spark.read.option("sep", "\t").option("header", True)
            .schema("o_orderkey long, o_custkey long, o_orderpriority string, o_totalprice double").csv(path))


@query("snk_02_marker_tables", "select marker, count(*) as n from train group by 1", "train")
def marker_tables(spark, d):
    path = scratch_path(spark, "training")
    tables.write_by(training.training_rows(cells(spark, d)), path, "marker")
    return spark.read.parquet(path).groupBy("marker").agg(F.count("*").alias("n"))


@query("snk_03_metric_csv", "select feature, count(v) as n, round(avg(v), 6) as mean from melted group by 1", "melted")
def metric_csv(spark, d):
    path = scratch_path(spark, "metrics")
    tables.write_csv(stats.running_stats(cells(spark, d), [], BASIC).select("feature", "n", "mean"), path)
    return rounded(spark.read.option("header", True).schema("feature string, n long, mean double").csv(path))


@query("snk_04_json", "select label, count(*) as n from tok where label in ('FOXP3+', 'FOXP3-') group by 1", "tok")
def json_log(spark, d):
    c, path = cells(spark, d), scratch_path(spark, "unmatched")
    tokens = boosting.unmatched_tokens(c, CELL_OPTIONS, BASIC, MARKERS)
    tables.write_json(boosting.unmatched_counts(c, tokens, CELL_OPTIONS), path)
    return spark.read.schema("label string, n long").json(path)


@query("snk_06_by_image", "select Image, count(*) as n, max(x_um) as x_max from cells group by 1")
def by_image(spark, d):
    path = scratch_path(spark, "images")
    tables.write_by(cells(spark, d), path, "Image")
    return spark.read.parquet(path).groupBy("Image").agg(F.count("*").alias("n"), F.max("x_um").alias("x_max"))
