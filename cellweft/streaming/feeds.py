"""File-stream counterparts of the label counts, the running statistics and the scoring.

Each query keeps one state row per (file, label) or (file, feature); nothing grows with the cells.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from cellweft.functions import labels as L
from cellweft.functions.numeric import to_number
from cellweft.functions.text import na_to_null
from cellweft.operators.scoring import MarkerModel, score
from cellweft.session import col
from cellweft.sources import catalog
from cellweft.sources.tables import source_name


def table_stream(spark: SparkSession, directory: str, columns: list[str], per_trigger: int | None = None) -> DataFrame:
    """New TSVs of a folder as they come. A stream needs its header up front: ``columns``.

    A file with another header is an error rather than silently shifted columns.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    reader = (spark.readStream.schema(schema).option("sep", "\t").option("header", True)
              .option("enforceSchema", False).option("recursiveFileLookup", True)
              .option("pathGlobFilter", "*.{tsv,csv}"))
    if per_trigger:
        reader = reader.option("maxFilesPerTrigger", per_trigger)
    raw = reader.csv(directory)
    text = lambda c: "centroid" not in c.lower() and catalog.is_metadata(c)
    return raw.select(source_name().alias("source_file"), *[
        (na_to_null(col(c)) if text(c) else to_number(col(c))).alias(c) for c in columns])


def running_label_counts(stream: DataFrame, label: str = "Classification", delimiter: str = "|") -> DataFrame:
    tokens = stream.filter(col(label).isNotNull()).select(
        F.col("source_file").alias("file"), F.explode(L.tokens(col(label), delimiter)).alias("label"))
    return tokens.filter(F.col("label") != "").groupBy("file", "label").agg(F.count("*").cast("long").alias("n"))


def running_feature_stats(stream: DataFrame, features: list[str]) -> DataFrame:
    long = stream.select("source_file", F.inline(F.array(*[
        F.struct(F.lit(f).alias("feature"), col(f).alias("v")) for f in features]))).filter(
        F.col("v").isNotNull() & ~F.isnan("v"))
    return long.groupBy("source_file", "feature").agg(
        F.count("v").cast("long").alias("n"), F.avg("v").alias("mean"), F.stddev_pop("v").alias("std"),
        F.min("v").alias("min"), F.max("v").alias("max"))


def write_complete(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Replace the result table with the whole current result after every batch."""
    def put(batch: DataFrame, _: int) -> None:
        batch.write.mode("overwrite").parquet(path)

    return (df.writeStream.outputMode("complete").foreachBatch(put)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def score_stream(stream: DataFrame, models: list[MarkerModel], keep: list[str], path: str,
                 checkpoint: str) -> StreamingQuery:
    """Score new tables; a batch that is run again replaces its own folder."""
    scored = score(stream, models, keep)

    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return (scored.writeStream.outputMode("append").foreachBatch(put)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
