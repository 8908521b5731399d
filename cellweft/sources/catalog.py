"""The column catalog: which columns are keys, metadata or features, and what each measures.

Column names are metadata of the plan, so the catalog is a plain list; ``frame`` turns it into a
DataFrame for joins of labels with columns.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellweft.session import col
from cellweft.settings import META_WORDS, Options

OWN_COLUMNS = ("row_key", "source_file")
NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


@dataclass(frozen=True)
class Feature:
    feature_id: str
    name: str
    marker: str
    compartment: str | None
    stat: str | None


def is_metadata(name: str) -> bool:
    low = name.lower()
    return name in OWN_COLUMNS or any(word.lower() in low for word in META_WORDS)


def describe_name(index: int, name: str) -> Feature:
    """Split ``Marker: Compartment: Stat``; the stat is the last part, missing parts are None."""
    parts = [p.strip() for p in name.split(":")]
    return Feature(f"f_{index:04d}", name, parts[0], parts[1] if len(parts) > 2 else None,
                   parts[-1] if len(parts) > 1 else None)


def features(columns: list[str]) -> list[Feature]:
    names = [c for c in columns if not is_metadata(c)]
    return [describe_name(i + 1, n) for i, n in enumerate(names)]


def frame(spark: SparkSession, columns: list[str]) -> DataFrame:
    rows = [(f.feature_id, f.name, f.marker, f.compartment, f.stat) for f in features(columns)]
    return spark.createDataFrame(
        rows, "feature_id string, original_name string, marker string, compartment string, stat string")


def metadata_columns(columns: list[str]) -> list[str]:
    return [c for c in columns if is_metadata(c)]


def feature_columns(columns: list[str]) -> list[str]:
    return [c for c in columns if not is_metadata(c)]


def training_features(columns: list[str], label: str = "key_label") -> list[str]:
    """Feature columns of a training table: the metadata words count case-sensitively here."""
    drop = re.compile("|".join(META_WORDS))
    return [c for c in columns if c != label and c not in OWN_COLUMNS and not drop.search(c)]


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC)]


def without_pattern(columns: list[str], pattern: str) -> list[str]:
    found = re.compile(pattern, re.IGNORECASE)
    return [c for c in columns if not found.search(c)]


# Columns left out of panel reports, small and large tables.
PANEL_SKIP = r"(Cytoplasm|Variance)"
PANEL_SKIP_LARGE = r"(Cytoplasm|Membrane|Nucleus|Min|Variance|Std\.Dev\.)"


def panel_markers(df: DataFrame) -> list[str]:
    return [c for c in numeric_columns(df) if "Median" in c and ("+" in c or "-" in c)]


def median_columns(columns: list[str]) -> list[str]:
    return [c for c in columns if "Median" in c]


def boost_columns(columns: list[str], options: Options) -> list[str]:
    """Label, kept context and medians: all that boosting carries on."""
    own = [c for c in OWN_COLUMNS if c in columns]
    context = [c for c in columns if c in options.context_columns]
    label = [c for c in (options.label_column,) if c in columns]
    return own + label + context + [m for m in median_columns(columns) if m not in context]


def marker_columns(columns: list[str], marker: str, label: str, extra: bool = True) -> list[str]:
    """Columns named ``marker:`` in any case, and key, centroid, image, ROI and label columns."""
    found = re.compile(rf"^{re.escape(marker)}\s*:", re.IGNORECASE)
    words = ("key_", "Centroid", "Image", "ROI", label)
    return [c for c in columns
            if found.match(c) or (extra and any(w in c for w in words))]


def prefixed_columns(columns: list[str], marker: str, exclude: tuple[str, ...] = (),
                     exact: bool = True) -> list[str]:
    """Feature columns of one marker. ``exact=False`` takes any name starting with the text."""
    names = feature_columns(columns)
    names = [c for c in names if not c.endswith("_label")]
    hit = [c for c in names if (c.split(":")[0].strip() == marker if exact else c.startswith(marker))]
    return [c for c in hit if not any(p and p in c for p in exclude)]


def position_columns(columns: list[str]) -> list[str]:
    return [c for c in columns if "centroid" in c.lower() or "image" in c.lower()]


def boxcox_columns(columns: list[str]) -> list[str]:
    return [c for c in columns if re.search(r"(Min|Max|Median|Mean|StdDev)", c)]


def intensity_columns(columns: list[str], object_type: str = "CellObject") -> list[str]:
    pattern = r"Cell: (Mean|Median)" if object_type == "CellObject" else r"(Mean|Median)"
    return [c for c in columns if re.search(pattern, c)]


def varying_columns(df: DataFrame, columns: list[str]) -> list[str]:
    """Columns with more than one value: one min/max pass, no distinct count."""
    if not columns:
        return []
    aggs = [(F.min(col(c)) < F.max(col(c))).alias(f"v{i}") for i, c in enumerate(columns)]
    row = df.agg(*aggs).first()
    return [c for i, c in enumerate(columns) if row[i]]


def with_safe_ids(df: DataFrame) -> DataFrame:
    """Rename feature columns to ``f_0001``... so that no name needs quoting or clashes."""
    ids = {f.name: f.feature_id for f in features(df.columns)}
    return df.toDF(*[ids.get(c, c) for c in df.columns])


def match_columns(labels: DataFrame, catalog: DataFrame, match: str = "exact",
                  text_column: str = "marker") -> DataFrame:
    """Best column per marker: ``Cell:`` columns first, then catalog order.

    ``exact`` compares catalog markers; ``contains`` takes any column whose name holds the marker.
    Both sides are metadata sized.
    """
    name = F.col("c.original_name")
    marker = F.col(f"l.{text_column}")
    rule = {
        "exact": F.col("c.marker") == marker,
        "contains": F.contains(name, marker),
        "prefix": F.startswith(name, marker),
        "delimited": F.concat(F.lit("."), F.regexp_replace(name, r"[_.\-: ]+", "."), F.lit(".")).contains(
            F.concat(F.lit("."), marker, F.lit("."))),
    }[match]
    pairs = labels.alias("l").join(F.broadcast(catalog.alias("c")), rule, "inner")
    order = F.struct((~F.contains(name, F.lit("Cell:"))).alias("a"), F.col("c.feature_id").alias("b"),
                     name.alias("original_name"))
    best = pairs.groupBy(*[F.col(f"l.{c}").alias(c) for c in labels.columns]).agg(F.min(order).alias("best"))
    return best.select(*labels.columns, F.col("best.b").alias("feature_id"),
                       F.col("best.original_name").alias("original_name"))
