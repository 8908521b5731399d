"""The input manifest: images matched with the masks and tables named after them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweft.functions.text import basename, decode_name


def list_files(spark: SparkSession, directory: str) -> DataFrame:
    """Paths below a directory; file contents are not read."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
             .option("pathGlobFilter", "*").load(directory))
    return files.select(decode_name(F.regexp_replace("path", r"^file:(//)?(?=/)", "")).alias("path"))


def _pieces(name: Column) -> Column:
    """Every substring that could be an image stem: the name cut at each end and start."""
    return F.flatten(F.transform(
        F.sequence(F.lit(1), F.length(name)),
        lambda i: F.transform(F.sequence(F.lit(1), F.length(name) - i + 1), lambda n: F.substr(name, i, n))))


def first_match(images: DataFrame, files: DataFrame, column: str) -> DataFrame:
    """The first file by path whose name contains the image stem.

    `contains` becomes an equi-join: each file name gives its substrings, and only those equal to a
    stem meet an image, so listings are never paired up.
    """
    pieces = files.select(F.col("path").alias(column),
                          F.explode(F.array_distinct(_pieces(basename(F.col("path"))))).alias("stem"))
    stems = images.select("stem").distinct()
    hit = pieces.join(stems, "stem", "left_semi").groupBy("stem").agg(F.min(column).alias(column))
    return images.join(hit, "stem", "left")


def build_manifest(images: DataFrame, masks: DataFrame, tables: DataFrame,
                   sample_in_key: bool = False, earlier: DataFrame | None = None) -> DataFrame:
    """(key, ome_path, segmask_path, quant_path); rows are added to an earlier manifest."""
    path = F.col("path")
    image = images.filter(F.lower(path).rlike(r"\.ome\.tiff?$")).select(path.alias("ome_path"))
    name = basename(F.col("ome_path"))
    sample = F.regexp_extract("ome_path", r"([^/]+)/[^/]*$", 1)
    key = F.concat_ws("/", sample, name) if sample_in_key else name
    image = image.select(key.alias("key"), "ome_path", F.regexp_replace(name, r"\.[^.]*$", "").alias("stem"))
    out = first_match(first_match(image, masks, "segmask_path"), tables, "quant_path")
    out = out.select("key", "ome_path", "segmask_path", "quant_path")
    return earlier.unionByName(out) if earlier is not None else out
