"""Text helpers: NA texts, file names, column-name cleaning."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from cellweft.settings import NA_TEXTS


def na_to_null(value: Column) -> Column:
    return F.when(~F.trim(value).isin(*NA_TEXTS), value)


def basename(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)/*$", 1)


def stem(path: Column) -> Column:
    return F.regexp_replace(basename(path), r"\.[^.]*$", "")


def decode_name(name: Column) -> Column:
    """Undo the percent-encoding of file metadata; ``+`` is a real plus sign there."""
    return F.url_decode(F.regexp_replace(name, r"\+", "%2B"))


# Image and table suffixes, and the subset number of a file name.
SUFFIX = r"(?i)(\.ome)?(\.tiff|\.tif|\.[^.]+)$"
SUBSET = r"_subset(\d+)"


def file_id(path: Column) -> Column:
    """File name without image or table suffix, with its subset number repeated if it has one."""
    name = basename(path)
    short = F.regexp_replace(name, SUFFIX, "")
    subset = F.regexp_extract(name, SUBSET, 1)
    return F.when(subset != "", F.concat(short, F.lit("_subset"), subset)).otherwise(short)


def safe_name(value: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(value, r"[^A-Za-z0-9]+", "_"), r"^_+|_+$", "")


def clean_column(name: str, drop_parentheses: bool = False) -> str:
    """Strip blanks, spell ``um`` as ``µm`` on centroids, optionally drop ``(...)``."""
    name = name.lstrip("﻿").strip()
    if drop_parentheses:
        name = re.sub(r"\s*\([^)]*\)", "", name)
    return re.sub(r"^(Centroid [XY]) um$", r"\1 µm", name)
