"""File streams, run until the files at hand are used up."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellweft.operators import scoring
from cellweft.queries.base import query, rounded
from cellweft.session import scratch_path
from cellweft.sources import tables
from cellweft.sources.cells import BASIC, cells
from cellweft.streaming import feeds


def _stream(spark, d):
    path = scratch_path(spark, "feed")
    data = cells(spark, d).drop("row_key")
    # A batch takes three files: were they one a task and table, batches would grow with the tasks that write.
    tables.write_tsv(data, path, ["source_file"], rows=tables.FILE_ROWS)
    names = [c for c in data.columns if c != "source_file"]
    return feeds.table_stream(spark, path, names, per_trigger=3)


def _run(spark, df):
    out = scratch_path(spark, "stream-out")
    feeds.write_complete(df, out, scratch_path(spark, "stream-state")).awaitTermination()
    return spark.read.parquet(out)


@query("str_01_label_counts", "select source_file as file, label, n from cnt", "cnt")
def label_counts(spark, d):
    return _run(spark, feeds.running_label_counts(_stream(spark, d)))


@query("str_02_feature_stats", """select source_file, feature, count(v) as n, round(avg(v), 6) as mean,
    round(stddev_pop(v), 6) as std, round(min(v), 6) as min, round(max(v), 6) as max from melted group by 1, 2""", "melted")
def feature_stats(spark, d):
    return rounded(_run(spark, feeds.running_feature_stats(_stream(spark, d), BASIC)))


@query("str_03_score_tables", "select source_file, 'CD3' as marker, count(*) as n from cells group by 1")
def score_tables(spark, d):
    from cellweft.queries.models import _models
    out = scratch_path(spark, "stream-scores")
    feeds.score_stream(_stream(spark, d), _models(spark, d)[:1], ["source_file", "Image"], out,
                       scratch_path(spark, "stream-state")).awaitTermination()
    scores = spark.read.parquet(out)
    return scores.groupBy("source_file", "marker").agg(F.count("probability").alias("n"))
