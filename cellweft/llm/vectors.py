"""Vectors in blocks: rows that hold a bounded number of vectors as binary matrices."""

from __future__ import annotations


import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellweft.session import col

BLOCK = "ids binary, data binary"


def valid(table: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """vec_id, v: rows with an id and a non-empty vector without null or non-finite components, as doubles."""
    v = F.transform(F.col("e"), lambda x: x.cast("double"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = table.select(col(vec_id).cast("long").alias("vec_id"), col(embedding).alias("e"))
    return rows.where("vec_id is not null and e is not null and size(e) > 0").select("vec_id", v.alias("v")).where(~bad)


def blocks(rows: DataFrame, keys: list[str], size: int, dtype: str = "<f8") -> DataFrame:
    """Vectors of one (bounded) group of ``keys`` as one row: ids, data and n. Sizes are bounded by how keys are made."""
    def pack(key, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("vec_id", kind="stable")
        data = np.array(pdf["v"].tolist(), dtype)
        return pd.DataFrame([[*key, pdf["vec_id"].to_numpy("<i8").tobytes(), data.tobytes(), len(pdf)]],
                            columns=[*keys, "ids", "data", "n"])
    kinds = dict(rows.dtypes)
    schema = ", ".join(f"{k} {kinds[k]}" for k in keys) + f", {BLOCK}, n long"
    return rows.groupBy(*keys).applyInPandas(pack, schema)


def matrix(ids: bytes, data: bytes, dtype: str = "<f8") -> tuple[np.ndarray, np.ndarray]:
    own = np.frombuffer(ids, "<i8")
    return own, np.frombuffer(data, dtype).reshape(len(own), -1)
