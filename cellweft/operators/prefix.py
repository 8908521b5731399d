"""Ordinals and prefix sums without sorting a whole group in one task: totals of buckets, then of buckets of buckets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellweft.session import attach, col, settle

FAN = 4096  # buckets that one window adds up


def offsets(totals: DataFrame, groups: list[str], bucket: str, sums: list[str], fan: int = FAN) -> DataFrame:
    """Adds ``before_<c>``, the total of ``c`` over the group's smaller buckets.

    ``totals`` (stored) holds one row per group and bucket number, 0 and up. A window sums at most ``fan`` rows: more
    buckets are folded ``fan`` to one, whose own offsets are found the same way.
    """
    top = totals.agg(F.max(col(bucket)).alias("m")).first()["m"]
    above = f"__{bucket}_above"
    marked = totals.withColumn(above, F.floor(col(bucket) / F.lit(fan)).cast("long"))
    window = Window.partitionBy(*[col(g) for g in groups], col(above)).orderBy(col(bucket)).rowsBetween(
        Window.unboundedPreceding, -1)
    local = marked.withColumns({f"before_{s}": F.coalesce(F.sum(col(s)).over(window), F.lit(0)) for s in sums})
    if top is None or top < fan:
        return local.drop(above)
    folded = settle(marked.groupBy(*[col(g) for g in groups], col(above)).agg(*[F.sum(col(s)).alias(s) for s in sums]),
                    "folded")
    upper = offsets(folded, groups, above, sums, fan).select(
        *[col(g) for g in groups], col(above), *[F.col(f"before_{s}").alias(f"__upper_{s}") for s in sums])
    placed = attach(local, upper, [*groups, above], "left", salt_by=[bucket])
    return placed.withColumns({f"before_{s}": F.col(f"before_{s}") + F.col(f"__upper_{s}") for s in sums}).drop(
        above, *[f"__upper_{s}" for s in sums])


def ordinals(df: DataFrame, order: list[Column], name: str = "ordinal", parts: int | None = None) -> DataFrame:
    """Adds the row's number from 0 in the order of ``order``: rows are sorted in ranges, ranges offset by their counts."""
    spark = df.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # The id holds the range's number from bit 33 up and the row's place in it below.
    sorted_rows = settle(df.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn(
        "__at", F.monotonically_increasing_id()), "ordinals")
    counts = settle(sorted_rows.groupBy(F.expr("shiftright(__at, 33)").alias("__range")).agg(F.count("*").alias("n")), "ranges")
    before = offsets(counts, [], "__range", ["n"]).select("__range", "before_n")
    placed = attach(sorted_rows.withColumn("__range", F.expr("shiftright(__at, 33)")), before, ["__range"], "left",
                    salt_by=["__at"])
    return placed.withColumn(name, F.expr("before_n + (__at & 8589934591)")).drop("__at", "__range", "before_n")
