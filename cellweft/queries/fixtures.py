"""Shared inputs of the queries: cells, synthetic scores and tables written as TSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweft.functions import labels as L
from cellweft.session import col, scratch_path
from cellweft.sources import tables
from cellweft.sources.cells import BASIC, cells, quant
from cellweft.settings import Options

KEY = ("Image", "x_um", "y_um")
# The cells' feature columns carry their marker in lower case.
MARKERS = {"cd3_cell_median": "CD3", "cd8_cell_median": "CD8", "cd31_cell_median": "CD31", "na2_cell_median": "NA2"}
CELL_OPTIONS = Options(context_columns=KEY)


def scored(spark: SparkSession, sf_dir: str, intensity: bool = False) -> DataFrame:
    """Synthetic predictions of two markers, long; CD8 lacks some cells. ``intensity`` adds the value each is made from."""
    c = cells(spark, sf_dir)

    def one(marker: str, value: str, centre: float, width: float) -> DataFrame:
        v = F.col(value)
        return c.select("row_key", "source_file", *KEY, F.lit(marker).alias("marker"),
                        F.round(1 / (1 + F.exp(-(v - centre) / width)), 6).alias("probability"),
                        F.when(v >= centre, 1).otherwise(0).alias("prediction"), "na2_cell_median",
                        *([v.alias("intensity")] if intensity else []))

    return one("CD3", "cd3_cell_median", 25, 8).unionByName(
        one("CD8", "cd8_cell_median", 50, 20).filter("na2_cell_median <> 3")).drop("na2_cell_median")


def truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scores beside the parsed label of their marker; cells without one are gone."""
    c = cells(spark, sf_dir)
    long = None
    for marker, value, centre, width in (("CD3", "cd3_cell_median", 25, 8), ("CD8", "cd8_cell_median", 50, 20)):
        rows = c if marker == "CD3" else c.filter("na2_cell_median <> 3")
        v = F.col(value)
        part = rows.select("row_key", "source_file", F.lit(marker).alias("marker"),
                           F.when(v >= centre, 1).otherwise(0).alias("prediction"),
                           F.round(1 / (1 + F.exp(-(v - centre) / width)), 6).alias("probability"),
                           L.parse_marker(F.col("Classification"), marker).alias("label"))
        long = part if long is None else long.unionByName(part)
    return long.filter("label is not null")


def written_tables(spark: SparkSession, sf_dir: str, drop_label_of: str | None = None) -> str:
    """The quant table as TSVs, one folder of part files per source, with two column orders (and
    optionally no label column in one source)."""
    path = scratch_path(spark, "dataset")
    data = quant(spark, sf_dir).drop("row_key")
    back = [c for c in reversed(data.columns)]
    first = F.col("source_file").isin("batch_0.tsv", "batch_1.tsv")
    parts = [(data.filter(first), "a"), (data.select(*[col(c) for c in back]).filter(~first), "b")]
    if drop_label_of:
        parts = [(d.filter(F.col("source_file") != drop_label_of), n) for d, n in parts]
        parts.append((data.filter(F.col("source_file") == drop_label_of).drop("Classification"), "c"))
    for part, name in parts:
        tables.write_tsv(part, f"{path}/{name}", ["source_file"])
    return path


def basic(df: DataFrame) -> list[str]:
    return [c for c in BASIC if c in df.columns]
